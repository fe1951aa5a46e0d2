"""Scores of whole texts against a plain version, whatever tier a word's count comes from."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from harmonia.llm import hmm

TEXTS = ["a a a b b c", "A b c d e é", "", None, "x y a b  b\tzz", "a b unseen words é", "d d e q", "a a b new", "b c d zz zz"]
HELD = {5, 7}


def plain(head, iterations):
    docs = [hmm.words((t or "").encode()) for t in TEXTS]
    count = Counter(w for i, d in enumerate(docs) if i not in HELD for w in d)
    ends = sum(i not in HELD for i in range(len(TEXTS)))
    total, distinct = sum(count.values()) + ends, len(count) + 1
    floor = math.log10(total + 0.5 * (distinct + 1))
    base = lambda w: math.log10(count[w] + 0.5) - floor
    # the words at or above the least count that leaves at most ``head``
    kept = [w for w in count if sum(1 for v in count.values() if v >= count[w]) <= head]
    cls = {w: i for i, w in enumerate(sorted(kept))}
    t, v = np.zeros(hmm.TAIL), np.zeros(hmm.TAIL)
    for w, c in count.items():
        if w not in cls:
            t[hmm.tail_class(w)] += c
            v[hmm.tail_class(w)] += 1
    share = np.full(hmm.HEAD + hmm.TAIL + 1, 0.5)
    for w, i in cls.items():
        share[i] += count[w]
    share[hmm.HEAD:hmm.HEAD + hmm.TAIL] += t
    share[-1] += ends
    share /= share.sum()
    codes = [np.array([cls.get(w, hmm.HEAD + hmm.tail_class(w)) for w in d] + [hmm.HEAD + hmm.TAIL]) for d in docs]
    train = [c.astype("<u2").tobytes() for i, c in enumerate(codes) if i not in HELD]
    model = hmm.first_model(share)
    for _ in range(iterations):
        model = hmm.improved(hmm.expected_counts(model, *hmm.stretches(train)), share)
    f = np.float64
    model = hmm.Model(*(x.astype(f) / x.astype(f).sum(axis=a, keepdims=True) for x, a in
                        ((model.start, 0), (model.after, 0), (model.move, 1), (model.emit, 0))))
    classes = hmm.log10_likelihood(model, codes)
    out = []
    for i, d in enumerate(docs):
        inside = sum(math.log10(count[w] + 0.5) - math.log10(t[k] + 0.5 * (v[k] + 1)) for w in d if w not in cls for k in [hmm.tail_class(w)])
        out.append((i in HELD, len(d) + 1, sum(count[w] > 0 for w in d) + 1, total, sum(map(base, d)) + math.log10(ends + 0.5) - floor, classes[i] + inside))
    return out


@pytest.mark.parametrize("head,middle", [(hmm.HEAD, hmm.MIDDLE), (2, hmm.MIDDLE), (2, 4), (0, 0)])
def test_score_equals_plain_version(spark, head, middle):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = hmm.score_documents(docs, F.col("doc_id").isin(*HELD), iterations=2, most_head=head, most_middle=middle).collect()
    got = {r.doc_id: r for r in rows}
    for i, want in enumerate(plain(head, 2)):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4]
        assert r.base_score == pytest.approx(want[4], abs=1e-9) and r.score == pytest.approx(want[5], rel=1e-4)
