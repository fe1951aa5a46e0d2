"""Document fingerprints as Merkle trees, in DataFrame functions only.

A text is cut at empty lines into sections, a section at line feeds into paragraphs, a paragraph into
runs of ``RUN`` words.  Runs hash to leaves, a paragraph hashes its leaves, a section its paragraphs and
the root its sections.  The cuts lose nothing, so roots are equal exactly if texts are (up to SHA-256).
Comparing two trees needs no text: equal roots end it, else equal sections drop out, and the paragraphs
of differing sections locate the edit.  The likeness of two trees is the share of leaves they have in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Words in a leaf.
RUN = 4
#: Ranges of doc_id in which neighbours are looked up, for each shuffle partition.
RANGES_PER_PARTITION = 2


def sections(text: Column) -> Column:
    return F.split(text, "\n\n", -1)


def _runs(paragraph: Column) -> Column:
    """The paragraph's runs of ``RUN`` space-separated words, in order; joined by spaces they give it back."""
    def runs(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / RUN).cast("int")),
                           lambda i: F.concat_ws(" ", F.slice(words, i * RUN + 1, RUN)))
    # the words are a lambda's argument so that they are split once and not anew for every run
    return F.transform(F.array(F.split(paragraph, " ", -1)), runs)[0]


def _node(kind: str, children: Column) -> Column:
    """Hash of a node: its level and its children's hashes in order."""
    return F.sha2(F.concat(F.lit(kind), F.concat_ws(",", children)), 256)


def tree(text: Column) -> Column:
    """Sections of paragraphs: array of (hash, array of paragraph hashes)."""
    paragraphs = F.transform(sections(text), lambda s: F.transform(
        F.split(s, "\n", -1), lambda p: _node("p", F.transform(_runs(p), lambda r: F.sha2(r, 256)))))
    return F.transform(paragraphs, lambda ps: F.struct(_node("s", ps).alias("hash"), ps.alias("paragraphs")))


def root(branches: Column) -> Column:
    return _node("r", F.transform(branches, lambda s: s["hash"]))


def leaves(text: Column) -> Column:
    """Distinct leaf hashes (64 bits) of a text."""
    return F.array_distinct(F.transform(
        F.flatten(F.transform(F.split(text, "\n", -1), _runs)), lambda r: F.xxhash64(r)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common leaves over all leaves of either: 1 for equal texts, 0 without a common leaf."""
    return 2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def first_difference(a: Column, b: Column) -> Column:
    """Path ``section/paragraph`` (from 1) of the first differing paragraph of two trees; null if there is none."""
    s = F.array_position(F.zip_with(a, b, lambda x, y: ~x["hash"].eqNullSafe(y["hash"])), True)
    pa, pb = (F.coalesce(F.get(t["paragraphs"], s.cast("int") - 1), F.array().cast("array<string>")) for t in (a, b))
    p = F.array_position(F.zip_with(pa, pb, lambda x, y: ~x.eqNullSafe(y)), True)
    return F.when(s > 0, F.concat_ws("/", s.cast("string"), p.cast("string")))


def fingerprint(docs: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """``docs`` with the root of each text's tree; a null text counts as empty."""
    return docs.withColumn(to, root(tree(F.coalesce(F.col(text), F.lit("")))))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with ``next_text``: the text of the next row by descending doc_id, null id last.

    Rows of one doc_id follow each other by text; the last row is followed by the first.  The order is
    cut into ranges of doc_id at approximate percentiles of the ids, so the window of each range is a task's
    work and texts are shuffled once.  A range's last row finds its neighbour because the rows with the
    largest id of the range below are added to it as guests.
    """
    spark = docs.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0]
    cuts = sorted(set(cuts or []))
    if cuts:
        # of blocks of cuts, find the block by its first cut, then the place in it
        step = max(1, round(len(cuts) ** 0.5))
        blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
        block = F.size(F.filter(F.array(*[F.lit(b[0]) for b in blocks]), lambda c: c <= F.col("doc_id")))
        inside = F.element_at(F.array(*[F.array(*map(F.lit, b)) for b in blocks]), F.greatest(block, F.lit(1)))
        at = F.when(F.col("doc_id").isNull(), -1).when(block == 0, 0).otherwise(
            (block - 1) * step + F.size(F.filter(inside, lambda c: c <= F.col("doc_id"))))
    else:
        at = F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), at.cast("int").alias("range"), F.lit(False).alias("guest"))
    # one (range, largest id) for each range: bounded by the number of ranges
    top = sorted(((r["range"], r["top"]) for r in placed.groupBy("range").agg(F.max("doc_id").alias("top")).collect()), key=lambda x: x[0])
    if not top:
        return placed.select("doc_id", "text", F.col("text").alias("next_text"))
    host_of = {below: above for (below, _), (above, _) in zip(top, top[1:])} | {top[-1][0]: top[0][0]}
    firsts = F.col("doc_id").isin([t for _, t in top if t is not None])
    if top[0][0] == -1:
        firsts = firsts | F.col("doc_id").isNull()
    host = F.create_map(*[F.lit(x) for pair in host_of.items() for x in pair])[F.col("range")]
    guests = placed.where(firsts).withColumn("range", host).withColumn("guest", F.lit(True))
    order = Window.partitionBy("range").orderBy(F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return (placed.unionByName(guests).withColumn("next_text", F.lead("text").over(order))
            .where(~F.col("guest")).drop("range", "guest"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): its tree against that of its edited text and of the next row's.

    The edited text has the last floor(n/2) of the n code points replaced by as many first ones of the next
    row's text (or all it has).  Null and empty texts are alike; an empty table gives no rows.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    pairs = with_next(docs).select(
        "doc_id", "text", "next_text", n.cast("long").alias("n_chars"),
        F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"),
                 F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    trees = pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own_tree"), tree(F.col("edited")).alias("edited_tree"),
        leaves(F.col("text")).alias("own"), leaves(F.col("edited")).alias("changed"), leaves(F.col("next_text")).alias("following"))
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", root(F.col("own_tree")).alias("fingerprint"), root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
        first_difference(F.col("own_tree"), F.col("edited_tree")).alias("first_edit"))


def op4_merkle(spark, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


_ROOT = """sha256('r' || array_to_string(list_transform(string_split({t}, chr(10) || chr(10)), lambda s:
    sha256('s' || array_to_string(list_transform(string_split(s, chr(10)), lambda p:
      sha256('p' || array_to_string(list_transform(
        range(0, len(string_split(p, ' ')), 4), lambda i: sha256(array_to_string(string_split(p, ' ')[i + 1:i + 4], ' '))), ','))), ','))), ','))"""
_LEAVES = """list_distinct(flatten(list_transform(string_split({t}, chr(10)), lambda p:
    list_transform(range(0, len(string_split(p, ' ')), 4), lambda i: array_to_string(string_split(p, ' ')[i + 1:i + 4], ' ')))))"""
_PARAGRAPHS = "list_transform(string_split({t}, chr(10) || chr(10)), lambda s: string_split(s, chr(10)))"

ORACLE_SQL = f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, coalesce(text, '')) AS k FROM documents
), pairs AS (
  SELECT a.doc_id, a.text, b.text AS following, length(a.text) AS n_chars,
         substring(a.text, 1, length(a.text) - length(a.text) // 2) || substring(b.text, 1, length(a.text) // 2) AS edited
  FROM ordered a JOIN ordered b ON b.k = a.k % (SELECT count(*) FROM ordered) + 1
), hashed AS (
  SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_ROOT.format(t="text")} AS fingerprint, {_ROOT.format(t="edited")} AS edited_fingerprint,
         {_LEAVES.format(t="text")} AS own, {_LEAVES.format(t="edited")} AS changed, {_LEAVES.format(t="following")} AS nextl,
         {_PARAGRAPHS.format(t="text")} AS a, {_PARAGRAPHS.format(t="edited")} AS b
  FROM pairs
), located AS (
  SELECT *, list_position(list_transform(range(1, greatest(len(a), len(b)) + 1), lambda i: a[i] IS DISTINCT FROM b[i]), true) AS s FROM hashed
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       2 * len(list_intersect(own, changed)) / (len(own) + len(changed)) AS near_edited,
       2 * len(list_intersect(own, nextl)) / (len(own) + len(nextl)) AS near_next,
       CASE WHEN s > 0 THEN s || '/' || list_position(list_transform(range(1, greatest(coalesce(len(a[s]), 0), coalesce(len(b[s]), 0)) + 1),
            lambda i: a[s][i] IS DISTINCT FROM b[s][i]), true) END AS first_edit
FROM located
"""
