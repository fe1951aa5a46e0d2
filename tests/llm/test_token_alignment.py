"""Alignment of two tokenizers against a plain version over whole texts."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from harmonia.llm import token_alignment as A

TEXTS = ["the quick brown fox", "Hello  wörld \U0001F600 x", "a▁b", "", None, " lead and trail ", "x\t y\r\nz", "<|endoftext|> </s> <0x41>", "﻿ab é é ﬁ",
         "   ", "日本語のテキスト と 한국어", "a\x00b", "\U0001F9D1‍\U0001F680 \U0001F9D1‍\U0001F680", "the quick brown fox", "word " * 3000, "x" * 4000, "ünï " * 50 + "\n\n  q", " nb  em"]


def plain(texts, both):
    """Groups, links and counts by whole texts and decoded bytes alone."""
    docs = []
    for t in texts:
        if not t:
            docs.append(None)
            continue
        whole = (" " + t).encode()
        a = both.a.encode(" " + t, add_special_tokens=False).ids
        b = both.b.encode(t)
        if b"".join(both.a_bytes[i] for i in a) != whole or b"".join(both.b_bytes[i] for i in b) != whole:
            docs.append(None)
            continue
        own_a = [k for k, i in enumerate(a) for _ in both.a_bytes[i]]
        own_b = [k for k, i in enumerate(b) for _ in both.b_bytes[i]]
        links = sorted(set(zip(own_a, own_b)))
        groups, ga, gb = [], [], []
        for p in range(len(whole)):
            if p == 0 or own_a[p] != own_a[p - 1]:
                ga.append(a[own_a[p]])
            if p == 0 or own_b[p] != own_b[p - 1]:
                gb.append(b[own_b[p]])
            if p + 1 == len(whole) or (own_a[p + 1] != own_a[p] and own_b[p + 1] != own_b[p]):
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
        docs.append((len(a), len(b), groups, [(a[i], b[j]) for i, j in links]))
    count = Counter(p for d in docs if d for p in set(d[3]))
    most = {}
    for (a, _), c in count.items():
        most[a] = max(most.get(a, 0), c)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((d[0], d[1], len(d[2]), len(d[3]), sum(count[p] == most[p[0]] for p in d[3]), sum(count[p] for p in d[3]),
                        hashlib.sha256(";".join(d[2]).encode()).hexdigest()))
    return out


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       # names that clash with what the operator makes
                       T.StructField("row", T.StringType()), T.StructField("codes", T.StringType()), T.StructField("n_a", T.StringType())])


@pytest.mark.parametrize("head", [A.HEAD, 5, 0])
def test_alignment_equals_plain_version(spark, head):
    both = A.aligner(*A.vocabularies())
    ids = [*range(len(TEXTS) - 2), None, 3]   # a null id, and one that repeats
    docs = spark.createDataFrame([(i, t, "r", "c", "n") for i, t in zip(ids, TEXTS)], SCHEMA)
    got = A.align_documents(docs, head=head)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, *p) for i, p in zip(ids, plain(TEXTS, both)))


def test_alignment_on_given_documents(spark):
    both = A.aligner(*A.vocabularies())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    got = {r[0]: tuple(r[1:]) for r in A.align_documents(docs).collect()}
    assert got == dict(zip([r.doc_id for r in rows], plain([r.text for r in rows], both)))
    assert sum(1 for g in got.values() if g[0]) > 0.9 * len(got)


def test_groups_are_real_outputs_and_empty_tables_pass(spark):
    docs = spark.createDataFrame([(1, "the fox", "r", "c", "n"), (2, None, "r", "c", "n")], SCHEMA)
    got = {r.doc_id: r for r in A.align_documents(docs, groups=True).collect()}
    assert hashlib.sha256(got[1].groups.encode()).hexdigest() == got[1].groups_sha256 and got[2].groups == ""
    assert A.align_documents(docs.where("false")).count() == 0


def test_chunks_make_up_the_text():
    for t in TEXTS:
        if t:
            assert "".join(A.Aligner.chunks(t)) == " " + t
