"""Secret scans by a linear-chain conditional random field.

Three patterns (assignments, access keys, long hexadecimal runs) give the base findings.  They also label what the field
learns from: the tokens of a finding's value are begin and inside, all others outside.  The field sees a token's
shape (kinds of characters, how they alternate, length, variety), the shapes and words before and behind it,
and features of the file; so it finds values that look and stand like secrets where no pattern fits.

Training maximises the likelihood (forward-backward in numpy, gradient steps) over a bounded sample: ``SAMPLE``
distinct texts with a finding and as many without, ``STRETCHES`` stretches of ``STRETCH`` tokens from each.  Decoding runs
Viterbi over whole texts.  A token whose outside score leads by more than any pair of transitions can make up
is outside on the best path whatever stands beside it, so texts fall into short pieces there and the pieces are decoded
side by side; the path is the same as without the cuts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fresh, materialise, table

#: Distinct texts with a finding that train the field, and as many without; stretches of either and tokens in one.
SAMPLE, STRETCHES, STRETCH = 1000, 2, 64
#: Words beside a secret that count by themselves, and how often they must stand there.
LEXICON, SEEN = 300, 5
STEPS, DECAY = 80, 0.1
#: Distinct words whose features a worker keeps.
CACHE = 200_000

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: A run shorter than asked for fails as a whole, so asking at once finds the same matches.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
#: Quick test for texts that may hold a finding; it only steers which texts are drawn for training.
MAYBE = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
TOKEN = re.compile(r"""[:=]|[^\s"'`,;()<>\[\]{}|:=]+""")
OUT, BEGIN, IN = 0, 1, 2


# ---- base findings ------------------------------------------------------------------------------------

def base(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the base findings, by start and kind."""
    found = [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


# ---- features -----------------------------------------------------------------------------------------

_CLASS = str.maketrans({**{chr(c): "9" for c in range(48, 58)}, **{chr(c): "A" for c in range(65, 91)}, **{chr(c): "a" for c in range(97, 123)},
                        **{chr(c): "." for c in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]}})
_STEPS = (1, 2, 3, 5, 8, 12, 16, 20, 24, 32, 40, 64)


def _bucket(n: int) -> int:
    return sum(n >= s for s in _STEPS)


def shape(word: str, lexicon: frozenset[str] | set[str] = frozenset()) -> tuple[str, ...]:
    """A token's features; words of letters have few, so that most tokens share theirs."""
    if word in ":=":
        return ("is " + word,)
    size = f"size {_bucket(len(word))}"
    if word.isalpha():
        case = "lower" if word.islower() else "upper" if word.isupper() else "title" if word[0].isupper() and word[1:].islower() else "mixed"
        low = word.lower()
        return (size, case, size + case) + (("word " + low,) if low in lexicon else ())
    low = word.lower()
    ascii_only = word.isascii()
    kinds = word.translate(_CLASS) if ascii_only else "u" + word.translate(_CLASS)
    have = "".join(k for k in "aA9.u" if k in kinds) if ascii_only else "u"
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    varied = f"varied {min(9, 10 * len(set(word)) // len(word))}"
    hexadecimal = "hex" if all(c in "0123456789abcdef" for c in low) else "plain"
    turns = f"changes {_bucket(changes)}"
    return (size, "have " + have, turns, varied, hexadecimal, size + have, size + hexadecimal, turns + have, "starts " + kinds[:2],
            *(("word " + low,) if low in lexicon else ()))


def file_features(text: str) -> tuple[str, ...]:
    """Features of the whole text: its size, how often it assigns, whether it has lines and braces."""
    signs = text.count("=") + text.count(":")
    return (f"file size {_bucket(len(text) // 256)}", f"file assigns {_bucket(4096 * signs // max(1, len(text)))}",
            f"file lines {int(chr(10) in text)} braces {int('{' in text)}")


PLACES = ("own", "before", "second before", "behind")


# ---- the field ----------------------------------------------------------------------------------------

@dataclass
class Field:
    """Weights by (place, feature) and by file feature, states x states transitions, and weights of the first state."""

    weights: dict[tuple[str, str], np.ndarray]
    files: dict[str, np.ndarray]
    move: np.ndarray
    start: np.ndarray
    lexicon: frozenset[str]

    def slack(self) -> float:
        """What transitions can be worth to a token at most, against its being outside."""
        into = np.concatenate([self.move - self.move[:, :1], (self.start - self.start[0])[None]]).max(axis=0)
        out = np.concatenate([self.move - self.move[:1], np.zeros((3, 1))], axis=1).max(axis=1)
        return float(max(into[s] + out[s] for s in (BEGIN, IN)))


@dataclass
class Scorer:
    """Scores of tokens under a field; a worker keeps the rows of words it has met."""

    model: Field
    words: dict[str, int] = field(default_factory=dict)
    shapes: dict[tuple[str, ...], int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=lambda: [np.zeros((4, 3))])   # row 0: before and behind the text

    def row(self, word: str) -> int:
        known = self.words.get(word)
        if known is None:
            features = shape(word, self.model.lexicon)
            known = self.shapes.get(features)
            if known is None:
                known = self.shapes[features] = len(self.rows)
                nought = np.zeros(3)
                self.rows.append(np.array([sum((self.model.weights.get((p, f), nought) for f in features), nought) for p in PLACES]))
            if len(self.words) < CACHE:
                self.words[word] = known
        return known

    def scores(self, texts: list[str], tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(scores of every token of every text, where each text ends)."""
        get, row = self.words.get, self.row
        ids = np.fromiter((x for ts in tokens for x in (0, 0, *[get(t) or row(t) for t in ts], 0)), dtype=np.int64)
        size = np.array([len(ts) for ts in tokens], dtype=np.int64)
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(3 * np.arange(len(size)) + 2, size)
        table = np.array(self.rows)
        nought = np.zeros(3)
        files = np.array([sum((self.model.files.get(f, nought) for f in file_features(t)), nought) for t in texts]).reshape(-1, 3)
        return (table[ids[at], 0] + table[ids[at - 1], 1] + table[ids[at - 2], 2] + table[ids[at + 1], 3] + np.repeat(files, size, axis=0), ends)


def viterbi(model: Field, scores: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The best state of every token; ties go to outside, then begin."""
    states = np.zeros(len(scores), dtype=np.int8)
    if not len(scores):
        return states
    free = scores[:, 1:].max(axis=1) - scores[:, OUT] >= -model.slack() - 1e-9
    first, last = np.zeros(len(scores), dtype=bool), np.zeros(len(scores), dtype=bool)
    full = np.diff(np.concatenate([[0], ends])) > 0
    last[ends[full] - 1] = True
    first[np.concatenate([[0], ends[full][:-1]])] = True
    begin = np.flatnonzero(free & (first | np.concatenate([[True], ~free[:-1]])))
    end = np.flatnonzero(free & (last | np.concatenate([~free[1:], [True]]))) + 1
    if not len(begin):
        return states
    order = np.argsort(begin - end, kind="stable")   # longest first
    begin, length = begin[order], (end - begin)[order]
    live = np.searchsorted(-length, -np.arange(length[0]), side="left")
    now = scores[begin] + np.where(first[begin][:, None], model.start, model.move[OUT])
    back = []
    ended = np.empty((len(begin), 3))
    for s in range(1, length[0] + 1):
        n = live[s] if s < length[0] else 0
        ended[n:len(now)] = now[n:]
        if not n:
            break
        ways = now[:n, :, None] + model.move
        back.append(ways.argmax(axis=1).astype(np.int8))
        now = ways.max(axis=1) + scores[begin[:n] + s]
    close = begin + length - 1
    state = (ended + np.where(last[close][:, None], 0.0, model.move[:, OUT])).argmax(axis=1)
    for s in range(length[0] - 1, -1, -1):
        n = live[s]
        states[begin[:n] + s] = state[:n]
        if s:
            state[:n] = back[s - 1][np.arange(n), state[:n]]
    return states


def tagged(text: str, states: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of runs of begin and inside."""
    out, now = [], None
    for m, s in zip(TOKEN.finditer(text), states.tolist()):
        if s == IN and now:
            now = (now[0], m.end())
            continue
        if now:
            out.append(now)
        now = (m.start(), m.end()) if s else None
    return out + ([now] if now else [])


def labels(text: str) -> tuple[list[str], np.ndarray]:
    """(tokens, states by the base findings)."""
    places = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    states, values = np.zeros(len(places), dtype=np.int8), sorted((v, e) for _, _, e, v in base(text))
    starts = np.array([s for s, _ in places])
    for v, e in values:
        hit = range(max(0, int(np.searchsorted(starts, v, side="right")) - 1), int(np.searchsorted(starts, e)))
        hit = [i for i in hit if places[i][1] > v and not states[i]]
        if hit:
            states[hit], states[hit[0]] = IN, BEGIN
    return [text[s:e] for s, e in places], states


def train(stretches: list[tuple[list[str], list[int], tuple[str, ...]]], steps: int = STEPS, decay: float = DECAY) -> Field | None:
    """A field from (tokens, states, file features); None without any begin.  The order of the stretches has no part in it."""
    stretches = sorted(s for s in stretches if len(s[0]))
    if not any(BEGIN in s for _, s, _ in stretches):
        return None
    beside = Counter()
    for tokens, states, _ in stretches:
        for i, s in enumerate(states):
            if s == BEGIN:
                beside.update(t.lower() for t in {*tokens[max(0, i - 3):i], *tokens[i + 1:i + 2]} if t not in ":=")
    lexicon = frozenset(w for w, n in sorted(beside.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n >= SEEN)
    stretches.sort(key=lambda s: -len(s[0]))
    length = np.array([len(t) for t, _, _ in stretches])
    live = np.searchsorted(-length, -np.arange(length[0]), side="left")
    upto = np.concatenate([[0], np.cumsum(live)])
    # tokens of a step stand together: all first tokens, all second ones, ...
    rows: dict[tuple[str, ...], int] = {(): 0}
    grid = np.zeros((len(stretches), length[0] + 3), dtype=np.int64)
    seen: dict[str, int] = {}
    y = np.zeros((len(stretches), length[0]), dtype=np.int64)
    for k, (tokens, states, _) in enumerate(stretches):
        for i, t in enumerate(tokens):
            if t not in seen:
                seen[t] = rows.setdefault(shape(t, lexicon), len(rows))
            grid[k, i + 2] = seen[t]
        y[k, :len(tokens)] = states
    take = [np.concatenate([grid[:live[s], s + 2 + o] for s in range(length[0])]) for o in (0, -1, -2, 1)]
    y = np.concatenate([y[:live[s], s] for s in range(length[0])])
    files = sorted({f for *_, fs in stretches for f in fs})
    file_of = np.zeros((len(stretches), len(files)))
    for k, (*_, fs) in enumerate(stretches):
        file_of[k, [files.index(f) for f in fs]] = 1
    owner = np.concatenate([np.arange(live[s]) for s in range(length[0])])
    features = sorted({f for r in rows for f in r})
    place = {f: i for i, f in enumerate(features)}
    has = np.zeros((len(rows), len(features)), dtype=np.float32)
    for r, i in rows.items():
        has[i, [place[f] for f in r]] = 1

    w = [np.zeros((len(features), 3)) for _ in PLACES]
    theta = {"files": np.zeros((len(files), 3)), "move": np.zeros((3, 3)), "start": np.zeros(3), **{f"w{i}": x for i, x in enumerate(w)}}
    # resilient steps: a weight's step grows while its gradient keeps its sign and halves when it turns
    pace, sign = ({k: np.full(x.shape, v) for k, x in theta.items()} for v in (0.05, 0.0))
    first = slice(0, live[0])
    truth = np.eye(3)[y]
    moves = np.zeros((3, 3))
    for s in range(1, length[0]):
        np.add.at(moves, (y[upto[s - 1]:upto[s - 1] + live[s]], y[upto[s]:upto[s + 1]]), 1)
    for _ in range(steps):
        score = sum((has @ theta[f"w{i}"])[take[i]] for i in range(4)) + (file_of @ theta["files"])[owner]
        top = score.max(axis=1, keepdims=True)
        emit = np.exp(score - top)
        move, start = np.exp(theta["move"]), np.exp(theta["start"])
        alpha, beta, scale = np.empty_like(emit), np.ones_like(emit), np.empty(len(y))
        a = start * emit[first]
        expected = np.zeros((3, 3))
        for s in range(length[0]):
            at = slice(upto[s], upto[s + 1])
            if s:
                a = (a[:live[s]] @ move) * emit[at]
            scale[at] = c = a.sum(axis=1)
            a = a / c[:, None]
            alpha[at] = a
        for s in range(length[0] - 1, 0, -1):
            at, before = slice(upto[s], upto[s + 1]), slice(upto[s - 1], upto[s - 1] + live[s])
            ahead = beta[at] * emit[at] / scale[at, None]
            beta[before] = ahead @ move.T
            expected += alpha[before].T @ ahead * move
        off = truth - alpha * beta
        by_row = [np.stack([np.bincount(t, weights=off[:, k], minlength=len(rows)) for k in range(3)], axis=1) for t in take]
        by_text = np.stack([np.bincount(owner, weights=off[:, k], minlength=len(stretches)) for k in range(3)], axis=1)
        gradient = {"files": file_of.T @ by_text, "move": moves - expected, "start": off[first].sum(axis=0), **{f"w{i}": has.T @ b for i, b in enumerate(by_row)}}
        for k, x in theta.items():
            now = np.sign(gradient[k] - decay * x)
            pace[k] = np.clip(pace[k] * np.where(now * sign[k] > 0, 1.2, np.where(now * sign[k] < 0, 0.5, 1.0)), 1e-6, 0.5)
            x += pace[k] * now
            sign[k] = now
    weights = {(p, f): theta[f"w{i}"][place[f]] for i, p in enumerate(PLACES) for f in features}
    return Field(weights, {f: theta["files"][i] for i, f in enumerate(files)}, theta["move"], theta["start"], lexicon)


# ---- over a table -------------------------------------------------------------------------------------

def training_stretches(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> list[tuple[list[str], list[int], tuple[str, ...]]]:
    """Stretches of ``sample`` distinct texts with and without a finding, drawn by a hash of the text.

    The driver gets at most 2 * sample hashes, then at most 2 * sample * STRETCHES stretches.
    """
    spark = docs.sparkSession
    hashed = docs.select(F.col(text).alias("text")).where(F.length(text) > 0).withColumn("h", F.xxhash64("text", F.lit(13)))
    distinct = materialise(hashed.select("h", F.col("text").rlike(MAYBE).alias("hit")).groupBy("h").agg(F.max("hit").alias("hit")), "secret-hashes")
    drawn = [r["h"] for hit in (True, False) for r in distinct.where(F.col("hit") == hit).orderBy("h").limit(sample).collect()]
    if not drawn:
        return []
    wanted = F.broadcast(spark.createDataFrame([(h,) for h in drawn], "wanted long"))   # 2 * sample rows

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met = set()   # at most 2 * sample
        for pdf in batches:
            for h, t in zip(pdf["h"], pdf["text"]):
                if h in met:
                    continue
                met.add(h)
                tokens, states = labels(t)
                begins = np.flatnonzero(states == BEGIN)
                # around the first and the last finding, else the first and the middle of the text
                around = [begins[0], begins[-1]] if len(begins) else [0, len(tokens) // 2]
                at = sorted({max(0, int(i) - STRETCH // 2) for i in around[:STRETCHES]})
                rows = [(h, i, tokens[i:i + STRETCH], states[i:i + STRETCH].tolist(), list(file_features(t))) for i in at]
                yield pd.DataFrame(rows, columns=["h", "i", "tokens", "states", "files"])

    cuts = (hashed.join(wanted, F.col("h") == F.col("wanted")).select("h", "text")
            .mapInPandas(cut, "h long, i int, tokens array<string>, states array<int>, files array<string>").dropDuplicates(["h", "i"]))
    return [(list(r["tokens"]), list(r["states"]), tuple(r["files"])) for r in cuts.collect()]


def find_secrets(docs: DataFrame, text: str = "text", to: str = "secrets", model: Field | None = None, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the column ``to``: array of (kind, start, end), by start and then kind, in code points, end exclusive.

    Base findings all stay; the field adds spans of kind ``crf`` that overlap none of them.  Without ``model`` one
    is trained on ``docs``; if nothing there has a base finding, the field finds nothing.  Null and empty texts have
    no secrets; repeated rows get the same ones; an empty table gives no rows.  All columns of ``docs`` stay,
    one named like ``to`` is replaced.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    model = model or train(training_stretches(docs, text, sample))
    shared = spark.sparkContext.broadcast(model)   # features that the sample has

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        scorer = Scorer(model) if model else None
        for texts in batches:
            texts = [t or "" for t in texts]
            found = [[(s, k, e) for s, k, e, _ in base(t)] for t in texts]
            for at, upto in _slices(texts) if scorer else ():
                some = texts[at:upto]
                tokens = [TOKEN.findall(t) for t in some]
                scores, ends = scorer.scores(some, tokens)
                states = viterbi(model, scores, ends)
                for k in np.unique(np.searchsorted(ends, np.flatnonzero(states), side="right")).tolist():
                    own = found[at + k]
                    more = [(s, 3, e) for s, e in tagged(some[k], states[ends[k] - len(tokens[k]):ends[k]])
                            if not any(s < b_end and b < e for b, _, b_end in own)]
                    found[at + k] = sorted(own + more)
            yield pd.Series([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in f] for f in found], dtype=object)

    return docs.withColumn(to, find(F.col(text)))


def _slices(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts, about ``most`` characters together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_secrets(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, to=fresh(docs, "secrets")).drop("text")

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, KINDS[:3]),
                        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "crf")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"))
