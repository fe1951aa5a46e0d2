"""Alignment of two tokenizers: a byte-level vocabulary (A) against sentence pieces (B).

Both read a space and the text.  ``tokenizers`` names each A token's characters, sentencepiece's proto each B piece's
bytes in the text; where neither side's neighbours overlap, an end that both name is a coarse cut.
A character that several tokens share (byte-level tokens inside a multibyte character, byte-fallback pieces) has no such
ends inside; there the tokens' decoded bytes refine the stretch between two coarse cuts.  The decoded bytes of
a stretch must be the stretch, on either side.  Ends that both sides share cut the tokens into groups; tokens whose bytes overlap
are linked.

Neither tokenizer joins anything over a lone space between two other characters (a pre-token of A begins there, and
no piece of B holds a space after another character; the constructor checks that), so a text may be cut
there and the alignment of a chunk looked up by the chunk; the whole text's is theirs in a row.

How many documents hold a pair of ids linked is counted in tasks first, then by a shuffle of distinct pairs.
The most frequent pairs (``HEAD`` at most) go to every task, all others meet the documents by a join; those are rare, so no key of that
join is hot.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, materialise, table, whole_numbers

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs that every task gets (24 bytes each).
HEAD = 1_000_000
#: Chunks after which a worker begins to forget, and the longest that it keeps.
CACHE, LONGEST = 250_000, 48
#: Distinct pairs that a task holds while it counts.
HELD = 1_000_000

SPACE = "▁"
#: A space that stands between two characters that are not white space.
LONE = re.compile(r" (?=\S)(?<=\S )")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark has dealt the cores already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.a_size, self.b_size = self.a.get_vocab_size(), self.b.vocab_size()
        entries = (self.a.id_to_token(i) or "" for i in range(self.a_size))
        self.a_bytes = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece runs over a space after another character: texts cannot be cut at spaces")
        self.names = [str(i) for i in range(max(self.a_size, self.b_size))]
        self.in_bytes = self.b.encode("é", return_type="proto").pieces[-1].end == 2   # or in characters
        self.code = np.dtype("<u4" if self.a_size * self.b_size < 1 << 32 else "<u8")
        #: entries of chunks met of late, and of those before them
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def _ends(self, whole: str) -> tuple | None:
        """(A ids, their byte ends, B ids, their byte ends) of a string that begins with the space; None if its tokens are not the string."""
        raw = whole.encode()
        a_code = self.a.encode(whole, add_special_tokens=False)
        pieces = self.b.encode(whole[1:], return_type="proto").pieces
        sides = []
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        byte_of = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
        a_spans = byte_of[np.fromiter(chain.from_iterable(a_code.offsets), dtype=np.int64).reshape(-1, 2)]
        b_found = np.fromiter((x for p in pieces for x in (p.id, p.begin, p.end)), dtype=np.int64).reshape(-1, 3)
        b_spans = b_found[:, 1:] + 1 if self.in_bytes else byte_of[b_found[:, 1:] + 1]   # behind the space that B adds
        for ids, spans, entry in ((a_code.ids, a_spans, self.a_bytes), (b_found[:, 0].tolist(), b_spans, self.b_bytes)):
            decoded = [entry[t] for t in ids]
            if not ids or b"".join(decoded) != raw:
                return None
            ahead = np.append(spans[1:, 0], len(raw))
            sides.append((ids, spans[:, 1], (spans[:, 1] == ahead) & (spans[:, 1] > spans[:, 0]), np.cumsum([len(d) for d in decoded])))
        # coarse: an end that both sides' spans name and no neighbour overlaps
        coarse = [np.zeros(len(raw) + 1, dtype=bool) for _ in sides]
        for marks, (_, span_end, clean, _) in zip(coarse, sides):
            marks[span_end[clean]] = True
        coarse = coarse[0] & coarse[1]
        out = []
        for ids, span_end, clean, length in sides:
            cut = clean & coarse[span_end]
            # fine: from the coarse cut before a token, the bytes decoded since
            last = np.maximum.accumulate(np.where(cut, np.arange(len(ids)), -1))
            before = np.concatenate([[-1], last[:-1]])
            end = np.where(before < 0, 0, span_end[before]) + length - np.where(before < 0, 0, length[before])
            if (end[cut] != span_end[cut]).any():
                return None
            out += [ids, end]
        return tuple(out)

    def _entries(self, chunks: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, groups as text, codes of linked pairs) of each chunk; None where the tokens are not the chunk.

        The chunks are encoded in a row; if the tokens are not the row, either half by itself.
        """
        found = self._ends("".join(chunks))
        if found is None:
            half = len(chunks) // 2
            return self._entries(chunks[:half]) + self._entries(chunks[half:]) if half else [None]
        a_ids, a_end, b_ids, b_end = found
        marks = np.zeros(a_end[-1] + 1, dtype=bool)
        marks[a_end] = True
        shared = b_end[marks[b_end]]
        to_a, to_b = np.searchsorted(a_end, shared, side="right"), np.searchsorted(b_end, shared, side="right")
        name, groups, i, j = self.names, [], 0, 0
        for p, q in zip(to_a.tolist(), to_b.tolist()):
            left = name[a_ids[i]] if p == i + 1 else ",".join([name[t] for t in a_ids[i:p]])
            right = name[b_ids[j]] if q == j + 1 else ",".join([name[t] for t in b_ids[j:q]])
            groups.append(f"{left}|{right}")
            i, j = p, q
        a_start, b_start = np.concatenate([[0], a_end[:-1]]), np.concatenate([[0], b_end[:-1]])
        lo, hi = np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_start, a_end, side="left")
        n = hi - lo
        upto = np.concatenate([[0], np.cumsum(n)])
        left = np.repeat(np.array(a_ids, dtype=np.int64), n)
        right = np.array(b_ids, dtype=np.int64)[np.arange(upto[-1]) - np.repeat(upto[:-1], n) + np.repeat(lo, n)]
        codes = (left * self.b_size + right).astype(self.code).tobytes()
        # chunks end where both sides do
        at = np.searchsorted(shared, np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks]))
        g, a, b = (np.concatenate([[0], x]).tolist() for x in (at + 1, to_a[at], to_b[at]))
        c = (upto[a] * self.code.itemsize).tolist()
        return [(a[k + 1] - a[k], b[k + 1] - b[k], g[k + 1] - g[k], ";".join(groups[g[k]:g[k + 1]]), codes[c[k]:c[k + 1]])
                for k in range(len(chunks))]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Space and text, cut before every lone space between two other characters."""
        return [" " + p for p in LONE.split(text)]

    def align(self, texts: list[str]) -> list[tuple | None]:
        """An entry for every text, as of a chunk; None where the tokens are not the space and the text, or the text is empty."""
        cut = [self.chunks(t) if t else [] for t in texts]
        young, old, unseen, apart = self.young, self.old, {}, []
        for chunks in cut:
            for c in chunks:
                if c not in young and c not in unseen:
                    if c in old:
                        young[c] = old[c]
                    elif c[-1].isspace() or c[1].isspace():   # no cut beside it
                        unseen[c] = None
                        apart.append(c)
                    else:
                        unseen[c] = None
        for c in apart:
            del unseen[c]
            young[c] = self._entries([c])[0]
        new = list(unseen)
        for at in range(0, len(new), 8192):
            some = new[at:at + 8192]
            young.update(zip(some, self._entries(some)))
        out = []
        for chunks in cut:
            entries = [young[c] for c in chunks]
            if not entries or None in entries:
                out.append(None)
                continue
            n_a, n_b, n_groups, groups, codes = zip(*entries)
            out.append((sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(codes)))
        for c in new + apart:
            if len(c) > LONGEST:
                del young[c]
        if len(young) > CACHE:
            self.old, self.young = young, {}
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker, kept from task to task."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def vocabularies() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)


def _slices(texts: list[str], most: int = 1 << 21) -> Iterator[list[str]]:
    """The texts in turn, about ``most`` characters together; a longer one by itself."""
    some, size = [], 0
    for t in texts:
        if some and size + len(t) > most:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def encode(docs: DataFrame, paths: tuple[str, str], text: str = "text", groups: bool = False) -> DataFrame:
    """``docs`` rows as (its columns but the text, row, n_a, n_b, n_groups, n_links, groups_sha256, codes, times[, groups]).

    ``codes`` are the distinct linked pairs, a * size of B + b, rising, ``times`` how often each is linked.
    """
    fields = "n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string,codes:binary,times:binary" + (",groups:string" if groups else "")

    @F.pandas_udf(f"struct<{fields}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        both = aligner(*paths)
        names = [f.split(":")[0] for f in fields.split(",")]
        for texts in batches:
            rows = []
            for some in _slices([t or "" for t in texts]):
                for got in both.align(some):
                    if got is None:
                        row = (0, 0, 0, 0, "", b"", b"", "")
                    else:
                        n_a, n_b, n_groups, named, codes = got
                        links = np.frombuffer(codes, both.code)
                        distinct, times = np.unique(links, return_counts=True)
                        row = (n_a, n_b, n_groups, len(links), hashlib.sha256(named.encode()).hexdigest(), distinct.tobytes(),
                               times.astype("<u4").tobytes(), named)
                    rows.append(row[:len(names)])
            yield pd.DataFrame(rows, columns=names)

    others = [F.col(c) for c in docs.columns if c != text]
    made = docs.select(*others, F.monotonically_increasing_id().alias("row"), run(F.col(text)).alias("made"))
    return made.select(*others, "row", "made.*")


def pair_counts(coded: DataFrame, code: np.dtype) -> DataFrame:
    """(code, c): in how many rows of ``coded`` each pair is linked; tasks count before the shuffle, in bounded tables."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                some = np.frombuffer(b"".join(pdf["codes"].iloc[at:at + 256]), code).astype(np.int64)
                codes, back = np.unique(np.concatenate([codes, some]), return_inverse=True)
                counts = np.bincount(back, weights=np.concatenate([counts, np.ones(len(some))]), minlength=len(codes)).astype(np.int64)
                if len(codes) > HELD:
                    yield pd.DataFrame({"code": codes, "c": counts})
                    codes, counts = codes[:0], counts[:0]
        yield pd.DataFrame({"code": codes, "c": counts})
    return coded.select("codes").mapInPandas(count, "code long, c long").groupBy("code").agg(F.sum("c").alias("c"))


def _least_of_head(pairs: DataFrame, head: int) -> int | None:
    """The least count that leaves at most ``head`` pairs at or above it; None if there is none."""
    upto, least = 0, None
    for r in pairs.groupBy("c").count().orderBy(F.desc("c")).limit(head + 1).collect():
        upto += r["count"]
        if upto > head:
            break
        least = r["c"]
    return least


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None,
                    head: int = HEAD, groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) for every row of ``docs``.

    ``groups`` adds the groups themselves, ``a1,a2|b1;a3|b2,b3``.  A null or empty text, and one whose decoded
    tokens are not the space and the text on both sides, has no tokens: zeros and ''.  Every row is a document of its own, so repeated
    rows count as often as they occur, whatever their ids; an id may be null.  Other columns are ignored.  Two
    best pairs of an A id that tie are both best.  An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    paths = paths or vocabularies()
    both = aligner(*paths)
    code, b_size = both.code, both.b_size
    coded = materialise(encode(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), paths, groups=groups), "alignment")
    pairs = materialise(pair_counts(coded, code), "alignment-pairs")
    best = pairs.groupBy(F.expr(f"code div {b_size}").alias("a")).agg(F.max("c").alias("most"))   # at most the entries of A
    pairs = materialise(pairs.withColumn("a", F.expr(f"code div {b_size}")).join(best, "a").select("code", "c", (F.col("c") == F.col("most")).alias("best")),
                        "alignment-best")
    least = _least_of_head(pairs, head)
    # at most HEAD rows
    known = [np.zeros(0, dtype=np.int64)] * 3 if least is None else whole_numbers(pairs.where(F.col("c") >= least), "code", "c", "best")
    order = np.argsort(known[0])
    shared = spark.sparkContext.broadcast((known[0][order], known[1][order], known[2][order].astype(bool)))
    rare = pairs if least is None else pairs.where(F.col("c") < least)

    @F.pandas_udf("struct<n_best:long,count_sum:long,rest:array<struct<code:long,times:long>>>")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        codes, counts, is_best = shared.value
        for own, times in batches:
            rows = []
            for o, t in zip(own, times):
                o, t = np.frombuffer(o, code).astype(np.int64), np.frombuffer(t, "<u4").astype(np.int64)
                at = np.searchsorted(codes, o)
                met = at < len(codes)
                met[met] = codes[at[met]] == o[met]
                at, n = at[met], t[met]
                rest = [{"code": c, "times": k} for c, k in zip(o[~met].tolist(), t[~met].tolist())]
                rows.append((int(n[is_best[at]].sum()), int((n * counts[at]).sum()), rest))
            yield pd.DataFrame(rows, columns=["n_best", "count_sum", "rest"])

    looked = coded.withColumn("found", look_up("codes", "times")).drop("codes", "times")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if groups else [])]
    if not rare.head(1):
        return looked.withColumn("n_best", F.col("found.n_best")).withColumn("count_sum", F.col("found.count_sum")).select(*names)
    looked = materialise(looked, "alignment-found")
    met = (looked.select("row", F.explode("found.rest").alias("r")).select("row", "r.code", "r.times").join(rare, "code")
           .groupBy(F.col("row").alias("of_row")).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                                      F.sum(F.col("times") * F.col("c")).alias("more_sum")))
    return (looked.join(met, F.col("row") == F.col("of_row"), "left")
            .withColumn("n_best", F.col("found.n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("found.count_sum") + F.coalesce("more_sum", F.lit(0))).select(*names))


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))
