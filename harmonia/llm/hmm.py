"""A hidden Markov language model over word classes.

Every word belongs to a class: a frequent word (``HEAD`` of them at most) is a class of its own, all
others share ``TAIL`` classes named by the hash of their last three bytes, and the end of a text is a class.
Latent states emit classes and move on; a word's probability in its class comes from its training count.
So the emission table has a fixed size while counts cover every training token, and the probabilities of all
texts add up to one.

Training is Baum-Welch over every training text: tasks run the scaled forward-backward recursions over
their texts in numpy, many texts abreast, and send expected counts by class; the counts are added across
partitions and the next iteration gets the new tables.  Texts are cut into stretches of ``STRETCH`` words for
training only.  Scoring runs the exact forward recursion over whole texts.  The first tables
are the corpus distribution with seeded random factors; the counts of every iteration come from all texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bound_batches, crc_mod, materialise, table, utf8, whole_numbers

HEAD, TAIL = 61_000, 4096
STATES = 8
ITERATIONS = 5
STRETCH = 256
#: Words' worth of the corpus distribution mixed into each state's emissions.
SMOOTH = 200.0
#: Words beyond the head whose counts every task gets (16 bytes each).
MIDDLE = 1_000_000
#: Words in a numpy block.
BLOCK_WORDS = 1 << 18


# ---- words and classes ------------------------------------------------------------------------------

def words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAIL


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over the binary column ``bytes``; tasks count before the shuffle, in bounded tables."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for t in pdf["bytes"]:
                seen.update(words(t))
            if len(seen) > 500_000:
                yield pd.DataFrame({"word": list(seen.keys()), "c": list(seen.values())})
                seen = Counter()
        yield pd.DataFrame({"word": list(seen.keys()), "c": list(seen.values())})
    return texts.mapInPandas(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _least(counts: DataFrame, most: int) -> int | None:
    """The least count that leaves at most ``most`` words at or above it; None if there is none."""
    upto, least = 0, None
    # one row for each distinct count; only as many as there are such words matter
    for r in counts.groupBy("c").count().orderBy(F.desc("c")).limit(most + 1).collect():
        upto += r["count"]
        if upto > most:
            break
        least = r["c"]
    return least


def head_words(counts: DataFrame, most: int = HEAD) -> dict[bytes, tuple[int, int]]:
    """word -> (class, count) of the words at or above the least count that leaves at most ``most``."""
    least = _least(counts, most)
    if least is None:
        return {}
    rows = counts.where(F.col("c") >= least).collect()
    return {w: (i, c) for i, (w, c) in enumerate(sorted((bytes(r["word"]), r["c"]) for r in rows))}


@dataclass
class Middle:
    """Counts of the most frequent words beyond the head, by the XXH64 of the word, rising; ``least`` is the least count among them."""

    hashes: np.ndarray
    counts: np.ndarray
    least: int | None


def middle_words(rare: DataFrame, most: int = MIDDLE) -> Middle:
    """At most ``most`` words of ``rare`` (word, c), 16 bytes each.

    Two of some million words share a hash once in a million corpora; such words' counts would go by either.
    """
    least = _least(rare, most)
    if least is None:
        return Middle(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), None)
    hashes, c = whole_numbers(rare.where(F.col("c") >= least).select(F.xxhash64("word").alias("h"), "c"), "h", "c")
    hashes = hashes.view(np.uint64)
    order = np.argsort(hashes)
    return Middle(hashes[order], c[order], least)


def encode(docs: DataFrame, head: dict[bytes, tuple[int, int]], total: int, distinct: int, middle: Middle, within: np.ndarray) -> DataFrame:
    """doc rows (doc_id, held_out, bytes) as class ids: codes, n_tokens, n_head (known words met), head_base and in_class (their
    scores), rest (the words that are neither in the head nor in the middle, space-joined).

    ``within`` is the log10 of each tail class's smoothed size.  Batches are worked off as one long text.
    """
    shared = docs.sparkSession.sparkContext.broadcast((head, middle, within))   # at most HEAD and MIDDLE words, TAIL numbers
    end = HEAD + TAIL
    floor = math.log10(total + 0.5 * (distinct + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        head, middle, within = shared.value
        cls = {w: i for w, (i, _) in head.items()}
        base = np.zeros(HEAD)
        for i, c in head.values():
            base[i] = math.log10(c + 0.5) - floor
        top = np.log10(middle.counts + 0.5)
        hash_of, get, crc = xxhash.xxh64_intdigest, cls.get, zlib.crc32
        for pdf in batches:
            split = [words(t) for t in pdf["bytes"]]
            size = np.array([len(ws) for ws in split], dtype=np.int64)
            flat = [w for ws in split for w in ws]
            doc = np.repeat(np.arange(len(split)), size)
            ids = np.fromiter((get(w, -1) for w in flat), dtype=np.int64, count=len(flat))
            rare = np.flatnonzero(ids < 0)
            head_base = np.bincount(doc, weights=base[ids] * (ids >= 0), minlength=len(split))
            n_head = size - np.bincount(doc[rare], minlength=len(split))
            seldom = [flat[i] for i in rare.tolist()]
            k = np.fromiter((crc(w[-3:]) % TAIL for w in seldom), dtype=np.int64, count=len(seldom))
            ids[rare] = HEAD + k
            h = np.fromiter((hash_of(w, 42) for w in seldom), dtype=np.uint64, count=len(seldom))
            at = np.searchsorted(middle.hashes, h)
            met = at < len(middle.hashes)
            met[met] = middle.hashes[at[met]] == h[met]
            of, worth = doc[rare[met]], top[at[met]]
            head_base += np.bincount(of, weights=worth - floor, minlength=len(split))
            in_class = np.bincount(of, weights=worth - within[k[met]], minlength=len(split))
            n_head += np.bincount(of, minlength=len(split))
            rest: list[list[bytes]] = [[] for _ in split]
            for i in np.flatnonzero(~met).tolist():
                rest[doc[rare[i]]].append(seldom[i])
            codes, stop, start = ids.astype("<u2"), np.cumsum(size).tolist(), 0
            last, out = np.array([end], dtype="<u2").tobytes(), []
            for e in stop:
                out.append(codes[start:e].tobytes() + last)
                start = e
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "codes": out, "n_tokens": size + 1, "n_head": n_head,
                                "head_base": head_base, "in_class": in_class, "rest": [b" ".join(r) for r in rest]})

    schema = "doc_id string, held_out boolean, codes binary, n_tokens long, n_head long, head_base double, in_class double, rest binary"
    return docs.mapInPandas(run, schema)


# ---- the model --------------------------------------------------------------------------------------

@dataclass
class Model:
    """start (S), move (S x S), emit (classes x S): probabilities; ``after`` starts a stretch inside a text."""

    start: np.ndarray
    after: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _blocks(texts: list[np.ndarray], most: int = BLOCK_WORDS) -> Iterator[list[int]]:
    """Indexes of texts of like length, longest first, about ``most`` words together."""
    block, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        block.append(i)
        size += len(texts[i])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def _abreast(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of texts (longest first) step by step, and how many texts reach each step."""
    length = np.array([len(t) for t in texts])
    live = (length[:, None] > np.arange(length[0])).sum(axis=0) if len(texts) * length[0] < 1 << 24 else np.array(
        [np.searchsorted(-length, -s, side="left") for s in range(length[0])])
    step = np.concatenate([np.arange(n) for n in length])
    place = np.concatenate([[0], np.cumsum(live)])
    row = np.repeat(np.arange(len(texts)), length)
    flat = np.empty(length.sum(), dtype=np.int64)
    flat[place[step] + row] = np.concatenate(texts)
    return flat, place


def log10_likelihood(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each class sequence, by the scaled forward recursion."""
    out = np.zeros(len(texts))
    for block in _blocks(texts):
        flat, place = _abreast([texts[i] for i in block])
        score, a = np.zeros(len(block)), None
        for s in range(len(place) - 1):
            e = model.emit[flat[place[s]:place[s + 1]]]
            n = len(e)
            a = (model.start if a is None else a[:n] @ model.move) * e
            c = a.sum(axis=1)
            a /= c[:, None]
            score[:n] += np.log10(c)
        out[block] = score
    return out


def expected_counts(model: Model, texts: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Baum-Welch counts over stretches: (start, after, move, emit), ``starts`` marking those that begin a text."""
    s_count, f_count = np.zeros(len(model.start)), np.zeros(len(model.start))
    m_count, e_count = np.zeros_like(model.move, dtype=np.float64), np.zeros(model.emit.shape)
    for block in _blocks(texts):
        flat, place = _abreast([texts[i] for i in block])
        first = starts[block]
        emit = model.emit[flat]
        alpha, steps = np.empty_like(emit), len(place) - 1
        scale = np.empty(len(flat), dtype=emit.dtype)
        a = np.where(first[:, None], model.start, model.after)
        for s in range(steps):
            lo, hi = place[s], place[s + 1]
            a = (a if s == 0 else a[:hi - lo] @ model.move) * emit[lo:hi]
            scale[lo:hi] = c = a.sum(axis=1)
            a /= c[:, None]
            alpha[lo:hi] = a
        beta = np.ones_like(emit)
        for s in range(steps - 1, 0, -1):
            lo, hi = place[s], place[s + 1]
            ahead = beta[lo:hi] * emit[lo:hi] / scale[lo:hi, None]
            beta[place[s - 1]:place[s - 1] + hi - lo] = ahead @ model.move.T
            m_count += alpha[place[s - 1]:place[s - 1] + hi - lo].T @ ahead * model.move
        gamma = alpha * beta
        head = gamma[:place[1]]
        s_count += head[first].sum(axis=0)
        f_count += head[~first].sum(axis=0)
        for k in range(gamma.shape[1]):
            e_count[:, k] += np.bincount(flat, weights=gamma[:, k], minlength=len(e_count))
    return s_count, f_count, m_count, e_count


def improved(counts: tuple[np.ndarray, ...], share: np.ndarray) -> Model:
    """New tables from expected counts; ``share`` is the corpus distribution over classes."""
    start, after, move, emit = counts
    emit = emit + SMOOTH * share[:, None]
    f = np.float32
    return Model(((start + 0.1) / (start + 0.1).sum()).astype(f), ((after + 0.1) / (after + 0.1).sum()).astype(f),
                 ((move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True)).astype(f), (emit / emit.sum(axis=0)).astype(f))


def stretches(codes: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Texts cut for training, and which pieces begin one."""
    out, first = [], []
    for c in codes:
        ids = np.frombuffer(c, "<u2")
        for at in range(0, len(ids), STRETCH):
            out.append(ids[at:at + STRETCH])
            first.append(at == 0)
    return out, np.array(first, dtype=bool)


def baum_welch(codes: DataFrame, model: Model, share: np.ndarray) -> Model:
    """One iteration over every row of ``codes``; counts are added by class across partitions."""
    shared = codes.sparkSession.sparkContext.broadcast(model)   # classes x states, a fixed size
    states = len(model.start)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            texts, first = stretches(pdf["codes"])
            got = expected_counts(shared.value, texts, first)
            total = got if total is None else tuple(a + b for a, b in zip(total, got))
        if total is not None:
            start, after, move, emit = total
            seen = np.flatnonzero(emit.sum(axis=1))
            at = np.concatenate([seen, -1 - np.arange(states), [-1 - states, -2 - states]])
            x = np.concatenate([emit[seen], move, start[None], after[None]])
            yield pd.DataFrame({"at": at, **{f"x{k}": x[:, k] for k in range(states)}})

    xs = [f"x{k}" for k in range(states)]
    parts = codes.select("codes").mapInPandas(run, "at long, " + ", ".join(f"{x} double" for x in xs))
    got = parts.groupBy("at").agg(*[F.sum(x).alias(x) for x in xs]).toPandas()   # at most classes + states + 2 rows
    at, x = got["at"].to_numpy(), got[xs].to_numpy()
    emit, rest = np.zeros_like(model.emit, dtype=np.float64), np.zeros((states + 2, states))
    emit[at[at >= 0]] = x[at >= 0]
    rest[-1 - at[at < 0]] = x[at < 0]
    return improved((rest[states], rest[states + 1], rest[:states], emit), share)


def first_model(share: np.ndarray, states: int = STATES, seed: int = 5) -> Model:
    """Tables that training starts from: no text has a part in them beyond the corpus distribution over classes."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * rng.uniform(0.5, 1.5, (len(share), states))
    move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    f = np.float32
    return Model(np.full(states, 1 / states, f), np.full(states, 1 / states, f), move.astype(f), (emit / emit.sum(axis=0)).astype(f))


def train(codes: DataFrame, share: np.ndarray, iterations: int = ITERATIONS) -> Model:
    """``iterations`` of Baum-Welch, each over every row of ``codes``."""
    model = first_model(share)
    for _ in range(iterations):
        model = baum_welch(codes, model, share)
    return model


# ---- scoring ----------------------------------------------------------------------------------------

def score_documents(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", iterations: int = ITERATIONS,
                    most_head: int = HEAD, most_middle: int = MIDDLE) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    The model learns from the rows where ``held_out`` is false.  A token is a word or the end of the text.
    ``base_score`` is the add-half unigram's log10 probability, ``score`` the hidden Markov model's.  Null texts
    count as empty (their one token is the end); repeated rows are scored each; an empty table gives no rows.
    Without training rows every word is unknown.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), utf8(F.col(text)).alias("bytes"))
    counts = materialise(count_words(rows.where("not held_out").select("bytes")), "hmm-counts")
    ends = rows.where("not held_out").count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = sums[0] + ends, sums[1] + (ends > 0)
    head = head_words(counts, most_head)
    least = min((c for _, c in head.values()), default=None)
    rare = counts if least is None else counts.where(F.col("c") < least)

    # the tail classes' sizes
    unseen_class = F.pmod(F.crc32(F.expr("substring(word, greatest(1, length(word) - 2), 3)")), F.lit(TAIL)).cast("int")   # tail_class
    by_class = rare.groupBy(unseen_class.alias("class")).agg(F.sum("c").alias("t"), F.count("*").alias("v"))
    sizes = {r["class"]: (r["t"], r["v"]) for r in by_class.collect()}   # at most TAIL rows
    t, v = (np.array([sizes.get(k, (0, 0))[i] for k in range(TAIL)], dtype=np.float64) for i in (0, 1))
    within = np.log10(t + 0.5 * (v + 1))

    middle = middle_words(rare, most_middle)
    coded = encode(rows.withColumn("doc_id", F.col("doc_id").cast("string")), head, total, distinct, middle, within)
    coded = materialise(coded.withColumn("row", F.monotonically_increasing_id()), "hmm-codes")

    # the words of neither head nor middle meet their counts by a join, an occurrence a row; each is rare, so no key is hot
    seldom = rare if middle.least is None else rare.where(F.col("c") < middle.least)
    sizes_of = coded.sparkSession.createDataFrame([(k, float(x)) for k, x in enumerate(within)], "of_class int, within double")   # TAIL rows
    occurs = coded.where(F.length("rest") > 0).select("row", F.explode(F.split(F.col("rest").cast("string"), " ")).alias("word")).select("row", F.col("word").cast("binary").alias("word"))
    met = (occurs.withColumn("class", unseen_class).join(F.broadcast(sizes_of), F.col("class") == F.col("of_class"))
           .join(seldom.select(F.col("word").alias("known"), "c"), F.col("word") == F.col("known"), "left")
           .withColumn("c", F.coalesce("c", F.lit(0))).withColumn("top", F.log10(F.col("c") + 0.5)))
    by_row = met.groupBy("row").agg(
        F.sum(F.col("top") - F.lit(math.log10(total + 0.5 * (distinct + 1)))).alias("tail_base"),
        F.sum(F.col("top") - F.col("within")).alias("tail_in_class"),
        F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("tail_known")).withColumnRenamed("row", "of_row")

    # the corpus distribution over classes
    share = np.full(HEAD + TAIL + 1, 0.5)
    for i, c in head.values():
        share[i] += c
    share[HEAD:HEAD + TAIL] += t
    share[-1] += ends
    model = train(coded.where("not held_out"), share / share.sum(), iterations)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def likelihood(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        exact = Model(*(x.astype(np.float64) for x in (shared.value.start, shared.value.after, shared.value.move, shared.value.emit)))
        exact = Model(exact.start / exact.start.sum(), exact.after / exact.after.sum(), exact.move / exact.move.sum(axis=1, keepdims=True),
                      exact.emit / exact.emit.sum(axis=0))
        for codes in batches:
            yield pd.Series(log10_likelihood(exact, [np.frombuffer(c, "<u2") for c in codes]))

    end_base = math.log10(ends + 0.5) - math.log10(total + 0.5 * (distinct + 1))
    scored = coded.select("row", "doc_id", "held_out", "n_tokens", "n_head", "head_base", "in_class", likelihood("codes").alias("classes"))
    zero = F.lit(0.0)
    return scored.join(by_row, F.col("row") == F.col("of_row"), "left").select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "held_out", "n_tokens",
        (F.col("n_head") + F.coalesce("tail_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", zero) + F.lit(end_base)).alias("base_score"),
        (F.col("classes") + F.col("in_class") + F.coalesce("tail_in_class", zero)).alias("score"))


def op5_hmm(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)
