"""Toxicity by weak supervision.

Voters are words and word beginnings that the training labels single out as a lexicon or as a pattern
(words that begin alike); every form that passes the tests votes, and no word votes that the labels do not support.
Each votes toxic on a document or abstains.  A generative label model tells how a document of either class comes by its votes: a number of
votes that start by themselves, who casts them, and, along a tree over the voters, who votes when its parent in the tree does.
The tree joins the voters that go together most beyond what the class explains, so the evidence of correlated voters is not
counted twice; the shares and rates are the voters' accuracies.  Expectation maximisation fits them to all distinct texts: training
labels keep their class in every step, the prior stays at their share, and unlabelled texts weigh as much as the labelled ones together
at most, so the fit cannot drift away from the labels.  The posterior labels
then train a linear classifier over hashed words and word beginnings, which scores whole texts.
"""

from __future__ import annotations

import logging
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, crc_mod, fresh, materialise, table

log = logging.getLogger(__name__)

#: Labelled documents of each class, about, from which voters are drawn.
PER_CLASS = 3000
#: A voter must be seen in so many toxic documents of the sample, be so much more frequent there (log), and by more than chance (G2).
SUPPORT, LIFT, SURPRISE = 4, 3.0, 15.0
#: EM ends when the expected counts move by less than this share, or raises the warning after so many steps.
SETTLED, EM_STEPS = 1e-3, 25
#: Starts above this number count as this many.  Pseudo-votes of the pooled shares, and of the pooled following rates.
MOST, POOLED, FOLLOWING = 6, 10.0, 4.0
#: Documents on each side of the posterior, about, that train the classifier.
PER_SIDE = 3000
BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
#: Weights of features other than voters are drawn to nought by this much.
SPARSE = 1e-3
CACHE = 200_000

_PLAIN = bytes.maketrans(bytes(range(65, 91)) + bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127)),
                         bytes(range(97, 123)) + b" " * (15 + 7 + 6 + 4))


def words(text: str | None) -> set[bytes]:
    """Distinct words: A-Z lower-cased, ASCII punctuation and white space between them."""
    return set((text or "").encode("utf-8", "replace").translate(_PLAIN).split())


def forms(word: bytes) -> list[bytes]:
    """The word and its beginnings (marked by a trailing ``*``)."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)]


def features(text: str | None) -> set[bytes]:
    return {f for w in words(text) for f in forms(w)}


@dataclass
class LabelModel:
    """How classes 0 and 1 vote.

    ``parent`` of each voter in the tree (-1: none); by class, log probabilities of the number of starts (``starts``) and of who casts one
    (``first``), and the probability that a voter follows its parent (``follow``).
    """

    voters: list[bytes]
    prior: float
    parent: np.ndarray
    starts: np.ndarray
    first: np.ndarray
    follow: np.ndarray

    def parts(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, voter, whether the vote follows its parent's) of every vote, and the number of starts of every pattern."""
        size = np.array([len(p) // 4 for p in patterns], dtype=np.int64)
        voter = np.frombuffer(b"".join(patterns), "<u4").astype(np.int64)
        row, k = np.repeat(np.arange(len(patterns)), size), max(1, len(self.voters))
        up = self.parent[voter] if len(voter) else voter
        follows = (up >= 0) & np.isin(row * k + up, row * k + voter)
        return row, voter, follows, np.bincount(row[~follows], minlength=len(patterns))

    def posterior(self, patterns: list[bytes]) -> np.ndarray:
        """P(toxic) of each pattern (voter numbers, 32 bits each)."""
        row, voter, follows, starts = self.parts(patterns)
        z = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for sign, c in ((1, 1), (-1, 0)):
            f = np.clip(self.follow[c], 1e-6, 1 - 1e-6)
            silent = np.zeros(len(self.voters))   # of all children, should they not follow
            np.add.at(silent, self.parent[self.parent >= 0], np.log(1 - f[self.parent >= 0]))
            vote = np.where(follows, np.log(f / (1 - f))[voter], self.first[c][voter]) + silent[voter]
            z += sign * (self.starts[c][np.minimum(starts, MOST)] + np.bincount(row, weights=vote, minlength=len(patterns)))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _training_labels(labels: DataFrame) -> DataFrame:
    """(labelled_id, toxic) of the training rows; an id labelled twice counts as toxic if any label does."""
    return (labels.where((F.col("toxic").isin(0, 1)) & (crc_mod(F.col("doc_id"), 5) != 0) & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("toxic").cast("int").alias("toxic")))


def _rate(n: dict[int, int], of: str, each: int) -> Column:
    """The share of a class (0 or 1) that leaves about ``each`` of its ``n`` rows, in 1/2**20."""
    return F.when(F.col(of) == 1, min(1.0, each / max(1, n.get(1, 0)))).otherwise(min(1.0, each / max(1, n.get(0, 0)))) * (1 << 20)


def induce_voters(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[list[bytes], np.ndarray, np.ndarray, float]:
    """(voters, their vote rates on toxic and on clean training rows, share of toxic rows)."""
    y = _training_labels(labels)
    of_class = {r[0]: r[1] for r in y.groupBy("toxic").count().collect()}
    prior = min(0.5, max(1e-3, of_class.get(1, 0) / max(1, sum(of_class.values()))))
    drawn = y.where(F.pmod(F.xxhash64("labelled_id", F.lit(10)), F.lit(1 << 20)) < _rate(of_class, "toxic", per_class))
    # about 2 * per_class ids, whatever the corpus
    labelled = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled_id")).select("text", "toxic")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        n = Counter()
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["toxic"]):
                seen[y].update(features(text))
                n[y] += 1
        both = seen[0].keys() | seen[1].keys()
        yield pd.DataFrame([(f, seen[1][f], seen[0][f]) for f in both] + [(None, n[1], n[0])], columns=["form", "toxic", "clean"])

    counts = (labelled.mapInPandas(count, "form binary, toxic long, clean long")
              .groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    counts = materialise(counts, "toxic-forms")
    # the candidates are bounded by the sample; only forms seen in toxic documents and rare in clean ones come back
    total = counts.where("form is null").first()
    n1, n0 = (max(1, total["toxic"]), max(1, total["clean"])) if total else (1, 1)
    seen, share = F.col("toxic") + F.col("clean"), n1 / (n1 + n0)
    surprise = 2 * (F.col("toxic") * F.log(F.col("toxic") / (seen * share))
                    + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (seen * (1 - share)))).otherwise(0))
    strong = (counts.where(F.col("form").isNotNull() & (F.col("toxic") > 0))
              .withColumn("lift", F.log(((F.col("toxic") + 0.5) / n1) / ((F.col("clean") + 0.5) / n0)))
              .where((F.col("lift") > LIFT) & (F.col("toxic") >= SUPPORT) & (surprise >= SURPRISE))
              .orderBy(F.desc(F.col("toxic") * F.col("lift")), "form").collect())   # forms of the sample
    rates = {bytes(r["form"]): (r["toxic"], r["clean"]) for r in strong}
    chosen: list[bytes] = []
    alike: dict[tuple[int, int], list[bytes]] = {}
    for f in rates:
        # a beginning that a chosen voter already stands for says nothing new
        stem, same = f.rstrip(b"*"), alike.setdefault(rates[f], [])
        if not any(c.startswith(stem) or stem.startswith(c) for c in same):
            same.append(stem)
            chosen.append(f)
    toxic = np.array([(rates[f][0] + 0.5) / (n1 + 1) for f in chosen])
    clean = np.array([(rates[f][1] + 0.5) / (n0 + 1) for f in chosen])
    return chosen, np.clip(toxic, 1e-4, 1 - 1e-4), np.clip(clean, 1e-5, 1 - 1e-4), prior


class Ballot:
    """Votes of texts: the numbers of the voters that vote, rising, 32 bits each."""

    def __init__(self, voters: list[bytes]):
        self.place = {f: i for i, f in enumerate(voters)}
        self.stands: dict[bytes, tuple[int, ...]] = {}

    def cast(self, text: str | None) -> bytes:
        votes: set[int] = set()
        for w in words(text):
            at = self.stands.get(w)
            if at is None:
                at = tuple(self.place[f] for f in forms(w) if f in self.place)
                if len(self.stands) < CACHE:
                    self.stands[w] = at
            if at:
                votes.update(at)
        return np.array(sorted(votes), dtype="<u4").tobytes()


def vote(docs: DataFrame, voters: list[bytes], to: str) -> DataFrame:
    """``docs`` with the votes of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)   # forms of the sample

    @F.pandas_udf("binary")
    def cast(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ballot = Ballot(shared.value)
        for texts in batches:
            yield pd.Series([ballot.cast(t) for t in texts], dtype=object)
    return docs.withColumn(to, cast(F.col("text")))


def voted_texts(docs: DataFrame, labels: DataFrame, voters: list[bytes]) -> DataFrame:
    """(h, pattern, y): a row per distinct text; y is its training label, null without one, and 1 if any of its documents is toxic."""
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text", F.lit(11)))
    cast = materialise(vote(hashed, voters, "pattern").drop("text"), "toxic-votes")
    y = _training_labels(labels)
    met = cast.join(y, F.col("doc_id") == F.col("labelled_id"), "left")
    return materialise(met.groupBy("h").agg(F.min("pattern").alias("pattern"), F.max("toxic").alias("y")), "toxic-texts")


def _weights(pdf: pd.DataFrame, model: LabelModel | None, share: float) -> tuple[list[bytes], np.ndarray]:
    """(patterns, weight of class 0 and 1 by row): known classes stay, the others get the model's posterior times ``share``."""
    patterns, n = [bytes(p) for p in pdf["pattern"]], pdf["n"].to_numpy(np.float64)
    y = pdf["y"].to_numpy(np.float64, na_value=np.nan)
    p = model.posterior(patterns) if model else np.zeros(len(patterns))
    known = ~np.isnan(y)
    toxic = np.where(known, np.nan_to_num(y), p)
    n = np.where(known, n, n * (share if model else 0.0))
    return patterns, np.stack([n * (1 - toxic), n * toxic])


def _expected(patterns: DataFrame, voters: list[bytes], parent: np.ndarray, model: LabelModel | None, share: float) -> np.ndarray:
    """Expected counts by class: numbers of starts (MOST + 1), then by voter starts, votes that follow, votes."""
    k = len(voters)
    shape = LabelModel(voters, 0.5, parent, None, None, None)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, MOST + 1 + 3 * k))
        for pdf in batches:
            named, w = _weights(pdf, model, share)
            row, voter, follows, starts = shape.parts(named)
            for c in (0, 1):
                total[c, :MOST + 1] += np.bincount(np.minimum(starts, MOST), weights=w[c], minlength=MOST + 1)
                for i, some in enumerate((~follows, follows, np.ones(len(voter), dtype=bool))):
                    at = MOST + 1 + i * k
                    total[c, at:at + k] += np.bincount(voter[some], weights=w[c][row[some]], minlength=k)
        yield pd.DataFrame({"c": [0, 1], "x": list(total)})

    parts = patterns.mapInPandas(sums, "c int, x array<double>").select("c", F.posexplode("x").alias("at", "x"))
    out = np.zeros((2, MOST + 1 + 3 * k))
    for r in parts.groupBy("c", "at").agg(F.sum("x").alias("x")).collect():   # a few numbers a voter
        out[r["c"], r["at"]] = r["x"]
    return out


def _model(counts: np.ndarray, voters: list[bytes], parent: np.ndarray, prior: float) -> LabelModel:
    """The model of highest likelihood for expected counts, smoothed towards what both classes do together."""
    k = len(voters)
    number, start, follow, votes = np.split(counts, [MOST + 1, MOST + 1 + k, MOST + 1 + 2 * k], axis=1)
    number = (number + 0.5) / (number + 0.5).sum(axis=1, keepdims=True)
    if not k:
        return LabelModel(voters, prior, parent, np.log(number), np.zeros((2, 0)), np.zeros((2, 0)))
    pooled = (start.sum(axis=0) + 0.5) / (start.sum() + 0.5 * k)
    first = (start + POOLED * pooled) / (start.sum(axis=1, keepdims=True) + POOLED)
    of_parent = np.where(parent >= 0, votes[:, parent], 0.0)
    together = (follow.sum(axis=0) + 0.5) / (of_parent.sum(axis=0) + 1.0)
    return LabelModel(voters, prior, parent, np.log(number), np.log(first), (follow + FOLLOWING * together) / (of_parent + FOLLOWING))


def correlation_tree(patterns: DataFrame, model: LabelModel, share: float) -> np.ndarray:
    """The parent of every voter in the forest that joins those that vote together most, given the class.

    Pairs that vote together are counted by class; their association (G2, added over the classes) must exceed ``SURPRISE``.
    """
    k = len(model.voters)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            named, w = _weights(pdf, model, share)
            for r, p in enumerate(named):
                ids = np.frombuffer(p, "<u4").tolist()
                for c in (0, 1):
                    seen[c, -1, -1] += w[c][r]
                    for x, i in enumerate(ids):
                        seen[c, i, -1] += w[c][r]
                        for j in ids[x + 1:]:
                            seen[c, i, j] += w[c][r]
        yield pd.DataFrame([(*key, n) for key, n in seen.items()], columns=["c", "i", "j", "n"])

    rows = patterns.mapInPandas(count, "c int, i int, j int, n double").groupBy("c", "i", "j").agg(F.sum("n").alias("n")).collect()   # voters squared at most
    n = {(r["c"], r["i"], r["j"]): r["n"] for r in rows}
    worth: Counter = Counter()
    for (c, i, j), both in n.items():
        if j < 0:
            continue
        total, a, b = n[c, -1, -1], n[c, i, -1], n[c, j, -1]
        if total <= 0 or both * total <= a * b:   # no company beyond chance
            continue
        cells = ((both, a * b), (a - both, a * (total - b)), (b - both, (total - a) * b), (total - a - b + both, (total - a) * (total - b)))
        worth[i, j] += sum(2 * x * np.log(x * total / e) for x, e in cells if x > 1e-9 and e > 0)
    root, near = list(range(k)), [[] for _ in range(k)]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (i, j), g in sorted(worth.items(), key=lambda x: (-x[1], x[0])):
        if g >= SURPRISE and find(i) != find(j):
            root[find(i)] = find(j)
            near[i].append(j)
            near[j].append(i)
    often = [n.get((0, i, -1), 0.0) + n.get((1, i, -1), 0.0) for i in range(k)]
    parent, met = np.full(k, -1, dtype=np.int64), set()
    for top in sorted(range(k), key=lambda i: (-often[i], i)):
        queue = [top] if top not in met else []
        met.update(queue)
        while queue:
            i = queue.pop()
            for j in near[i]:
                if j not in met:
                    parent[j] = i
                    met.add(j)
                    queue.append(j)
    return parent


def fit_label_model(docs: DataFrame, labels: DataFrame, steps: int = EM_STEPS) -> tuple[LabelModel, DataFrame]:
    """The label model, and the votes of the distinct texts (h, pattern, y)."""
    voters, _, _, prior = induce_voters(docs, labels)
    texts = voted_texts(docs, labels, voters)
    return fit_votes(texts, voters, prior, steps), texts


def fit_votes(texts: DataFrame, voters: list[bytes], prior: float, steps: int = EM_STEPS) -> LabelModel:
    """Expectation maximisation over rows (pattern, y)."""
    patterns = materialise(texts.groupBy("pattern", "y").agg(F.count("*").alias("n")), "toxic-patterns")
    known, unknown = patterns.agg(F.coalesce(F.sum(F.when(F.col("y").isNotNull(), F.col("n"))), F.lit(0)),
                                  F.coalesce(F.sum(F.when(F.col("y").isNull(), F.col("n"))), F.lit(0))).first()
    share = min(1.0, known / max(1, unknown))
    alone = np.full(len(voters), -1, dtype=np.int64)
    model = _model(_expected(patterns, voters, alone, None, share), voters, alone, prior)
    if not voters or not known:
        return model
    parent = correlation_tree(patterns, model, share)
    model, before = _model(_expected(patterns, voters, parent, None, share), voters, parent, prior), None
    for _ in range(steps):
        counts = _expected(patterns, voters, parent, model, share)
        model = _model(counts, voters, parent, prior)
        if before is not None and np.abs(counts - before).sum() <= SETTLED * counts.sum():
            return model
        before = counts
    log.warning("the label model had not settled after %d steps", steps)
    return model


@dataclass
class Classifier:
    """Linear over hashed word forms, each counted once a document."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None], cache: dict[bytes, float]) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        for i, t in enumerate(texts):
            total = 0.0
            for w in words(t):
                s = cache.get(w)
                if s is None:
                    s = float(sum(self.weights[zlib.crc32(f) % BUCKETS] for f in forms(w)))
                    if len(cache) < CACHE:
                        cache[w] = s
                total += s
            z[i] += total
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train_classifier(docs: DataFrame, texts: DataFrame, model: LabelModel, per_side: int = PER_SIDE, steps: int = 400) -> Classifier:
    """Logistic regression on the posterior labels of a bounded sample, sparse by soft thresholding.

    ``texts`` holds the votes of every distinct text of ``docs``.  The sample takes at most ``per_side`` distinct texts from either
    side of the posterior, those of smallest hash.
    """
    def sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            _, w = _weights(pdf.assign(n=1), model, 1.0)
            yield pd.DataFrame({"h": pdf["h"], "p": w[1], "side": (w[1] >= 0.5).astype("int32")})

    judged = materialise(texts.mapInPandas(sides, "h long, p double, side int"), "toxic-sides")
    drawn = {r["h"]: (r["side"], r["p"]) for side in (0, 1) for r in judged.where(F.col("side") == side).orderBy("h").limit(per_side).collect()}

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[int] = set()   # 2 * per_side at most
        for pdf in batches:
            for h, text in zip(pdf["h"], pdf["text"]):
                if h not in met:
                    met.add(h)
                    at = np.unique(np.fromiter((zlib.crc32(f) % BUCKETS for f in features(text)), dtype="<i4"))
                    yield pd.DataFrame({"h": [h], "at": [at.tobytes()]})

    got = []
    if drawn:
        wanted = F.broadcast(docs.sparkSession.createDataFrame([(h,) for h in drawn], "wanted long"))   # 2 * per_side rows
        hashed = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text", F.lit(11)))
        rows = hashed.join(wanted, F.col("h") == F.col("wanted")).select("h", "text").mapInPandas(hashes, "h long, at binary").dropDuplicates(["h"]).collect()
        got = sorted((*drawn[r["h"]], bytes(r["at"])) for r in rows)
    w, bias = np.zeros(BUCKETS), float(np.log(model.prior / (1 - model.prior)))
    if not got:
        return Classifier(w.astype(np.float32), bias)
    side, y = np.array([g[0] for g in got]), np.array([g[1] for g in got])
    at = [np.frombuffer(g[2], "<i4") for g in got]
    flat, length = np.concatenate(at).astype(np.int64), np.array([len(a) for a in at])
    row = np.repeat(np.arange(len(at)), length)
    of_side = np.bincount(side, minlength=2)
    weight = np.where(side == 1, 0.5 / max(1, of_side[1]), 0.5 / max(1, of_side[0]))
    used, flat, often = np.unique(flat, return_inverse=True, return_counts=True)
    steady = often >= SUPPORT   # what fewer texts of the sample hold is learnt by heart
    # the labels vouch for the voters' own forms: those are not drawn to nought
    pull = np.where(np.isin(used, [zlib.crc32(f) % BUCKETS for f in model.voters]), 0.0, SPARSE)
    # from the label model's evidence of a lone vote on
    v, b = np.zeros(len(used)), float(model.starts[1][0] - model.starts[0][0])
    start = {zlib.crc32(f) % BUCKETS: e for f, e in zip(model.voters, model.starts[1][1] - model.starts[0][1] - b + model.first[1] - model.first[0])}
    for i, at_bucket in enumerate(used.tolist()):
        v[i] = max(0.0, start.get(at_bucket, 0.0))
    grad2 = np.full(len(used), 1e-4)
    for _ in range(steps):
        z = np.bincount(row, weights=v[flat], minlength=len(at))
        for _ in range(3):   # the bias by Newton's steps, so that no common word has to stand for it
            p = 1 / (1 + np.exp(-np.clip(z + b, -60, 60)))
            b -= float(np.clip((weight * (p - y)).sum() / ((weight * p * (1 - p)).sum() + 1e-6), -1, 1))
        g = weight * (1 / (1 + np.exp(-np.clip(z + b, -60, 60))) - y)
        d = np.bincount(flat, weights=g[row], minlength=len(used))
        grad2 += d * d
        rate = 0.3 / np.sqrt(grad2)
        v = v - rate * d
        v = np.sign(v) * np.maximum(0, np.abs(v) - rate * pull) * steady
    w[used] = v
    return Classifier(w.astype(np.float32), float(b))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Voters and label model from all ``docs`` and the training ``labels``, then the classifier."""
    bound_batches(docs.sparkSession)
    model, texts = fit_label_model(docs, labels)
    return train_classifier(docs, texts, model)


def score(docs: DataFrame, classifier: Classifier, to: str = "score") -> DataFrame:
    """``docs`` with the probability of toxicity in column ``to``, which replaces one of that name; all other columns stay.

    Null texts score like empty ones, equal texts alike, long ones whole; an empty table gives no rows.  Without any
    training label no word votes and every text gets about the least prior, 0.001.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)   # BUCKETS floats

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[bytes, float] = {}
        for texts in batches:
            yield pd.Series(shared.value.scores(list(texts), cache))
    return docs.withColumn(to, probability(F.col("text")))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5; only its own columns."""
    to = fresh(docs, "toxic_score")
    return score(docs, fit(docs, labels), to).where(F.col(to) < 0.5).select(*docs.columns)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
