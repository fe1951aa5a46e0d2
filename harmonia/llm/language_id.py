"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its byte 3- and 4-grams (inside words, a space standing for
either end), hashed into ``BUCKETS`` rows.  Embeddings and the softmax over them are trained by
stochastic gradient descent in numpy on a bounded sample of labelled documents; the softmax is
calibrated by a temperature on documents held back from that sample, and the confidence below which a
prediction is rejected comes from the same documents.  Scoring is a pass over whole texts in which the
product of embeddings and softmax, a table of ``BUCKETS`` x languages, is all the model a task needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bound_batches, crc_mod, fresh, table

BUCKETS = 1 << 14
DIMENSION = 16
#: Training documents of each language, about: the bound of the labelled sample.
PER_LANGUAGE = 600
#: The share of rightly labelled calibration documents that may fall below the rejection bound.
REJECT = 0.0005
EPOCHS, RATE, BATCH = 12, 4.0, 32
#: Bytes hashed at a time, which bounds the memory of a very long text.
SLICE = 1 << 20
UNDETERMINED = "und"

_SPACE = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")


def subwords(text: bytes) -> Iterator[np.ndarray]:
    """Hashes of the text's 3- and 4-grams without a space inside, a slice of the text at a time."""
    padded = b" " + text.translate(LOWER).translate(_SPACE) + b" "
    for at in range(0, len(padded), SLICE):
        b = np.frombuffer(padded, dtype=np.uint8, count=min(SLICE + 3, len(padded) - at), offset=at)
        if len(b) < 3:
            continue
        w = b.astype(np.uint32)
        three = w[:-2] * np.uint32(0x9E3779B1) ^ w[1:-1] * np.uint32(0x85EBCA77) ^ w[2:] * np.uint32(0xC2B2AE3D)
        solid = b[1:-1] != 32
        last = len(three) if at + SLICE >= len(padded) else SLICE   # the slices overlap by the n-gram's length
        yield _mixed(three[:last][solid[:last]])
        four = three[:-1] ^ w[3:] * np.uint32(0x27D4EB2F)
        yield _mixed(four[:last][(solid[:-1] & solid[1:])[:last]] + np.uint32(0x165667B1))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """``table``: softmax weight of each subword bucket for each language, already divided by the temperature."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    reject: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and calibrated probabilities; ``und`` and 0 for null texts and texts without a letter."""
        names, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            if not self.languages or text is None or not has_letter(text):
                names.append(UNDETERMINED)
                continue
            total, n = np.zeros(len(self.languages)), 0
            for h in subwords(text.encode("utf-8", "replace")):
                total += self.table[h].sum(axis=0, dtype=np.float64)
                n += len(h)
            z = total / max(1, n) + self.bias
            p = np.exp(z - z.max())
            k = int(p.argmax())
            names.append(self.languages[k])
            scores[i] = p[k] / p.sum()
        return names, scores


def _sample(docs: DataFrame, text: str, lang: str, per_language: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, counts) of about ``per_language`` documents of each language, drawn by a hash of the text."""
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))])
    drawn = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, t in zip(pdf["lang"], pdf["text"]):
                if has_letter(t):
                    n = np.zeros(BUCKETS, dtype=np.int64)
                    for h in subwords(t.encode("utf-8", "replace")):
                        n += np.bincount(h, minlength=BUCKETS)
                    at = np.flatnonzero(n)
                    rows.append((name, at.astype("<u2").tobytes(), n[at].astype("<f4").tobytes()))
            yield pd.DataFrame(rows, columns=["lang", "at", "n"])

    got = drawn.mapInPandas(features, "lang string, at binary, n binary").collect()
    # duplicate texts draw alike; one of each is enough to learn from, and the order must not depend on tasks
    return [(a, np.frombuffer(b, "<u2").astype(np.int64), np.frombuffer(c, "<f4").astype(np.float64))
            for a, b, c in sorted({(r["lang"], bytes(r["at"]), bytes(r["n"])) for r in got})]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, seed: int = 7) -> Model:
    """A model of the languages in ``docs.lang``; rows without text, letters or language teach nothing."""
    bound_batches(docs.sparkSession)
    sample = _sample(docs, text, lang, per_language)
    languages = sorted({s[0] for s in sample})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 0.0)
    rng = np.random.default_rng(seed)
    label = np.array([languages.index(s[0]) for s in sample])
    mean = [(s[1], s[2] / s[2].sum()) for s in sample]
    order = rng.permutation(len(sample))
    fit, check = (order[len(order) // 5:], order[:len(order) // 5]) if len(order) >= 20 else (order, order)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSION))
    out, bias = rng.normal(0, 0.1, (DIMENSION, len(languages))), np.zeros(len(languages))
    steps, step = EPOCHS * max(1, len(fit) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for at in range(0, len(fit), BATCH):
            part = fit[at:at + BATCH]
            hidden = np.stack([w @ embed[i] for i, w in (mean[k] for k in part)])
            z = hidden @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), label[part]] -= 1
            rate = RATE * max(0.05, 1 - step / steps)
            back = p @ out.T
            out -= rate * hidden.T @ p / len(part)
            bias -= 0.1 * rate * p.mean(axis=0)
            for k, g in zip(part, back):
                i, w = mean[k]
                embed[i] -= rate * BUCKETS ** 0.5 / len(part) * w[:, None] * g
            step += 1
    weights = embed @ out
    z = np.stack([w @ weights[i] for i, w in (mean[k] for k in check)]) + bias
    y = label[check]

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    t = min(np.geomspace(0.1, 20, 80), key=loss)
    p = np.exp(z / t - (z / t).max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    # at least the confidence of a blind guess, at most an even bet
    reject = min(0.5, max(1 / len(languages), float(np.quantile(right, REJECT)) - 0.05)) if len(right) else 0.0
    return Model(languages, (weights / t).astype(np.float32), bias / t, reject if len(languages) > 1 else 0.0)


def identify(docs: DataFrame, model: Model, text: str = "text", to: str = "language") -> DataFrame:
    """``docs`` with a struct column: ``lang_pred``, ``score`` and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so is everything if
    the model learned from nothing.  A prediction below the calibrated bound keeps its language and is marked.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)   # BUCKETS x languages floats

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = shared.value.predict(list(texts))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    found = predict(F.col(text))
    out = docs.withColumn(to, found)
    return out.withColumn(to, F.struct(
        F.col(f"{to}.lang_pred").alias("lang_pred"), F.col(f"{to}.score").alias("score"),
        ((F.col(f"{to}.lang_pred") == UNDETERMINED) | (F.col(f"{to}.score") < F.lit(model.reject))).alias("rejected")))


def identified_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected; only its own columns."""
    to = fresh(docs, "language")
    model = train(docs.where(crc_mod(F.col("doc_id"), 3) != 1))
    return identify(docs, model, to=to).where(~F.col(f"{to}.rejected")).select(*docs.columns)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", crc_mod(F.col("doc_id"), 3) == 1)
    model = train(docs.where("not held_out"))
    return identify(docs, model).select("doc_id", "held_out", "language.lang_pred", "language.score", "language.rejected")
