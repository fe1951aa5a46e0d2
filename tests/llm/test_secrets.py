"""Secret scans: the patterns against their plain form, Viterbi against all paths, the field on wording it has not seen."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from harmonia.llm import secrets as S

WORDS = "the quick brown fox jumps over a lazy dog and runs far away from old houses by rivers in March 2021 or 12 May, call 555-0142".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def value(rng, n):
    return "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz0123456789") for _ in range(n))


def plain(text):
    """The findings as worded: greedy runs first, then the ones that are too short go."""
    kinds = [("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
              lambda m: len(m.group(2)) >= 6), ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 24)]
    found = sorted((m.start(), k, m.end(), name) for k, (name, p, fits) in enumerate(kinds) for m in re.finditer(p, text) if fits(m))
    return [f"{name}:{s}:{e}" for s, _, e, name in found]


def test_base_equals_plain_patterns():
    rng = random.Random(1)
    pieces = ["password", "PassWd", "api_key", "APIKEY", "ſecret", "toKen", "=", ":", " ", '"', "'", "abc", "abcdef", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef",
              "ef01", "é", "K", "x+/=", "\n", "  ", "secret"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert [f"{S.KINDS[k]}:{s}:{e}" for s, k, e, _ in S.base(text)] == plain(text), text


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    for trial in range(60):
        model = S.Field({}, {}, rng.normal(size=(3, 3)) * rng.choice([0.2, 2]), rng.normal(size=3), frozenset())
        sizes = rng.integers(0, 7, size=4)
        scores = rng.normal(size=(sizes.sum(), 3)) * 3
        scores[:, 0] += rng.choice([0, 4], size=len(scores))
        got = S.viterbi(model, scores, np.cumsum(sizes))
        for n, end in zip(sizes, np.cumsum(sizes)):
            own = scores[end - n:end]

            def worth(path):
                return sum(own[i, s] + (model.start[s] if i == 0 else model.move[path[i - 1], s]) for i, s in enumerate(path))
            if n:
                assert worth(got[end - n:end]) == pytest.approx(max(map(worth, itertools.product(range(3), repeat=int(n)))))


@pytest.fixture(scope="module")
def field():
    rng = random.Random(7)
    stretches = []
    for i in range(300):
        text = prose(rng, 30)
        if i % 2:
            text += rng.choice([" password = ", " token: ", ' secret="', " api_key="]) + value(rng, rng.randint(12, 40)) + " " + prose(rng, 10)
        tokens, states = S.labels(text)
        stretches.append((tokens, states.tolist(), S.file_features(text)))
    return S.train(stretches)


def found(model, text):
    tokens = [S.TOKEN.findall(text)]
    scores, ends = S.Scorer(model).scores([text], tokens)
    return [text[s:e] for s, e in S.tagged(text, S.viterbi(model, scores, ends))]


def test_field_learns_the_labels_and_wording_no_pattern_has(field):
    rng = random.Random(8)
    for _ in range(20):
        v, w = value(rng, 24), prose(rng, 20)
        assert found(field, f"{w} password = {v} {w}") == [v]
        assert found(field, f"{w} passphrase = {v} {w}") == [v]      # no base pattern names it
        assert found(field, f"{w} {w}") == []
    assert plain("passphrase = " + value(rng, 24)) == []


def test_training_ignores_order_and_needs_a_finding():
    rng = random.Random(9)
    stretches = []
    for i in range(20):
        tokens, states = S.labels(prose(rng, 9) + (" token = " + value(rng, 20) if i % 2 else ""))
        stretches.append((tokens, states.tolist(), ("f",)))
    one, two = S.train(stretches, steps=5), S.train(stretches[::-1], steps=5)
    assert np.allclose(one.move, two.move) and one.lexicon == two.lexicon
    assert S.train([s for s in stretches if 1 not in s[1]]) is None and S.train([]) is None


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("secrets", T.StringType()), T.StructField("h", T.StringType())])


def test_over_a_table_with_odd_rows(spark):
    rng = random.Random(5)
    key = "0123456789abcdef" * 2
    texts = [None, "", "é token = " + key + " end", prose(rng, 40000) + " AKIA" + "Z" * 16, "é token = " + key + " end", prose(rng, 50)]
    texts += [prose(rng, 20) + " password: " + value(rng, 20) for _ in range(30)]
    docs = spark.createDataFrame([(None if i == 4 else i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    got = S.find_secrets(docs).collect()
    assert S.find_secrets(docs).columns == ["doc_id", "text", "secrets", "h"] and len(got) == len(texts)
    for r in got:
        own = [f"{s.kind}:{s.start}:{s.end}" for s in r.secrets]
        assert [s for s in own if not s.startswith("crf")] == plain(r.text or "")
        assert own == [f"{s.kind}:{s.start}:{s.end}" for s in sorted(r.secrets, key=lambda s: (s.start, S.KINDS.index(s.kind)))]
    assert S.find_secrets(docs.where("false")).count() == 0
    assert all(not r.secrets for r in S.find_secrets(docs.where("doc_id in (0, 1, 5)")).collect())


def test_query_columns(spark):
    rows = S.op13_secrets(spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts) and sum(r.n_assign for r in rows) and sum(r.n_hex for r in rows)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k + ":") for w in want) for k in ("assign", "access", "hex")]
        assert set(want) <= set(filter(None, r.spans.split(",")))
