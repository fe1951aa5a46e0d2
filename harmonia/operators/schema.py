"""Schema operators: header-name cleaning (names as rows), canonical schema building, fuzzy
table inference, padding, and type reconciliation across table versions.

Header rows are data: ``(file, pos, name)``.  Thousands of raw files are cleaned and
classified by one Spark job.  Fuzzy matching compares header names with the reference
columns only where the similarity threshold can be reached: candidate pairs come from an
inverted index of character n-grams (``operators.similarity``), never from a cross
join; the expensive similarity is computed once per distinct (reference, test) name pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lookups as L
from ..functions import names as N
from ..session import scratch_path
from .similarity import length_band, levenshtein_similarity, ratcliff_ratio, similar_names, similarity  # noqa: F401 (also offered from here)

#: Matched header rows that one task aggregates.
ROWS_PER_TASK = 200_000

# ---- header names (M9-M13, Q5) ------------------------------------------------------------------


def clean_header_rows(headers: DataFrame, abbreviations: dict | None = None,
                      shipped_right_rule: bool = False) -> DataFrame:
    """headers(file, pos, name) -> + clean_name, keep (first of equal clean names), too_long.

    Per file: if any raw name is 59+ characters, names are shortened (camelCase/separator
    tokens, consecutive duplicates dropped, abbreviations, unique suffix from MD5), else
    simply sanitised.  Then the database pass; empty results become col_<pos>.
    """
    abbreviations = abbreviations or {}
    w_file = Window.partitionBy("file")
    h = headers.withColumn("_long", F.max(F.length("name")).over(w_file) >= L.MAX_COLUMN_NAME)
    h = h.withColumn("_tok", N.name_tokens(F.col("name")))
    h = h.withColumn("_tok", N.dedup_consecutive("_tok"))
    h = h.withColumn("_tok", N.abbreviate(F.col("_tok"), abbreviations))
    h = h.withColumn("_tok", N.dedup_consecutive("_tok"))
    short = N.join_tokens(F.col("_tok"))
    if abbreviations:  # whole-name abbreviations (the intent of the long-name maps)
        m = F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv])
        short = F.coalesce(F.try_element_at(m, short), short)
    h = h.withColumn("_short", short)
    rn = F.row_number().over(Window.partitionBy("file", "_short").orderBy("pos"))
    suffix = F.substring(F.md5(F.col("_short")), 1, 4)
    h = h.withColumn("_rn", rn).withColumn(
        "_short", F.when(F.col("_rn") == 1, F.col("_short"))
        .when(F.col("_rn") == 2, F.concat_ws("_", "_short", suffix))
        .otherwise(F.concat_ws("_", F.col("_short"), suffix, (F.col("_rn") - 1).cast("string"))))
    base = F.when(F.col("_long"), F.col("_short")).otherwise(N.simple_name(F.col("name")))
    final = N.sql_name(base, shipped_right_rule)
    final = F.when(final == "", F.concat(F.lit("col_"), F.col("pos").cast("string"))).otherwise(final)
    h = h.withColumn("clean_name", final)
    keep = F.row_number().over(Window.partitionBy("file", "clean_name").orderBy("pos")) == 1
    return (h.withColumn("keep", keep)
            .withColumn("too_long", F.length("clean_name") >= L.MAX_COLUMN_NAME)
            .drop("_long", "_tok", "_short", "_rn"))


_NAME_PLANS: dict = {}


def clean_names_for(spark, columns: list[str], abbreviations: dict | None = None) -> list[tuple]:
    """(pos, clean_name, keep, too_long) per column.  A pure function of the header, computed
    by ``clean_header_rows`` on a one-file header and memoised by header."""
    key = (tuple(columns), tuple(sorted((abbreviations or {}).items())))
    if key not in _NAME_PLANS:
        hdr = spark.createDataFrame([("f", i, c) for i, c in enumerate(columns)], "file string, pos int, name string")
        rows = sorted(clean_header_rows(hdr, abbreviations).collect(), key=lambda r: r["pos"])
        _NAME_PLANS[key] = [(r["pos"], r["clean_name"], r["keep"], r["too_long"]) for r in rows]
    return _NAME_PLANS[key]


def apply_clean_names(df: DataFrame, abbreviations: dict | None = None, strict: bool = True) -> DataFrame:
    """Rename a DataFrame's columns with ``clean_header_rows`` and drop later duplicates.
    The column list is metadata (bounded by the width of the table)."""
    rows = [dict(zip(("pos", "clean_name", "keep", "too_long"), r))
            for r in clean_names_for(df.sparkSession, df.columns, abbreviations)]
    too_long = [r["clean_name"] for r in rows if r["too_long"]]
    if strict and too_long:
        raise ValueError(f"column names of {L.MAX_COLUMN_NAME}+ characters: {too_long}")
    tmp = [f"_c{i}" for i in range(len(df.columns))]
    renamed = df.toDF(*tmp)
    return renamed.select(*[F.col(tmp[r["pos"]]).alias(r["clean_name"]) for r in rows if r["keep"]])


# ---- canonical schema, matching and inference (M1-M5, Q2, Q7) -----------------------------------

def canonical_schema(headers: DataFrame, aliases: DataFrame, key: str = "file") -> DataFrame:
    """headers(<key>, file_rank, pos, name) + aliases(<key>, table) -> (table, pos, column):
    per table, the ordered union of its files' columns, first occurrence kept.

    Names are first reduced to the least rank at every position, a plain number that hash aggregates keep in place, so the
    join and the minimum of structs (which sorts its input) see few rows, however many files share a key."""
    by_pos = headers.groupBy(key, "name", "pos", F.col("file_rank").isNull().alias("unranked")).agg(F.min("file_rank").alias("file_rank"))
    firsts = (by_pos.join(aliases, key)
              .groupBy("table", F.col("name").alias("column"))
              .agg(F.min(F.struct("file_rank", "pos")).alias("first")))
    w = Window.partitionBy("table").orderBy(F.col("first.file_rank"), F.col("first.pos"))
    return firsts.select("table", (F.row_number().over(w) - 1).cast("bigint").alias("pos"), "column")


def unmapped_files(files: DataFrame, aliases: DataFrame, key: str = "file") -> DataFrame:
    """Files without a canonical table (the build must stop if any)."""
    return files.join(aliases.select(key), key, "left_anti")


def best_renames(columns: list[str], canonical: list[str], spark, threshold: float = 0.9,
                 method: str = "levenshtein") -> dict[str, str]:
    """For one file's header: test column -> canonical column for the best match at or above the
    threshold, above 0 (exact names are left alone).  Header lists are metadata, so this runs on two tiny
    DataFrames and collects at most one row per canonical column."""
    hdr = spark.createDataFrame([("f", i, c) for i, c in enumerate(columns)], "file string, pos int, name string")
    can = spark.createDataFrame([(c,) for c in canonical], "column string")
    lo, hi = length_band(method, threshold, F.length("column"))   # one header against one table: an index would cost more than it saves
    ref = can.withColumn("tlen", F.explode(F.sequence(lo, hi)))
    pairs = hdr.withColumn("tlen", F.length("name")).join(ref, "tlen")
    pairs = pairs.withColumn("sim", similarity(method, F.col("column"), F.col("name"))).filter(F.col("sim") >= F.lit(threshold))
    w = Window.partitionBy("column").orderBy(F.col("sim").desc(), F.col("pos"))
    best = pairs.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").collect()
    return {r["name"]: r["column"] for r in best if r["name"] != r["column"] and r["name"] not in canonical}


def good_pairs(headers: DataFrame, canon: DataFrame, threshold: float, method: str = "levenshtein") -> DataFrame:
    """(table, column, name): distinct (reference column, header name) pairs whose similarity reaches the threshold, by the
    similarity join of ``operators.similarity``.  A name that several tables have is compared once."""
    near = similar_names(headers, canon, threshold, method)
    return canon.select("table", "column").distinct().join(near, "column").select("table", "column", "name")


def _file_scores(headers: DataFrame, canon: DataFrame, threshold: float, method: str) -> DataFrame:
    """(file, table, score) per file and matched table; a file without any match keeps one row
    with a null table.  Header rows are shuffled once, by file; the aggregations after it are
    clustered by file and need no further exchange.

    The matches are written to the shared folder first: their size decides whether the join sends them to the tasks, and the rows it
    makes can be counted by name.  Their number sets that of the tasks, so that no task's aggregates grow with the input."""
    spark = headers.sparkSession
    path = scratch_path(spark, "matches")
    good_pairs(headers, canon, threshold, method).write.parquet(path)
    good = spark.read.parquet(path)
    sizes = canon.groupBy("table").agg(F.countDistinct("column").alias("n_ref"))
    matches = good.groupBy("name").agg(F.count(F.lit(1)).alias("matches"))
    per_name = headers.groupBy("name").agg(F.count(F.lit(1)).alias("n")).join(matches, "name", "left")
    rows = per_name.agg(F.sum(F.col("n") * F.coalesce("matches", F.lit(1)))).first()[0] or 0
    hits = (headers.select("file", "name").join(good, "name", "left")
            .repartition(max(1, -(-rows // ROWS_PER_TASK)), "file"))
    per_table = hits.groupBy("file", "table").agg(F.countDistinct("column").alias("matched"))
    return per_table.join(sizes, "table", "left").select(
        "file", "table", F.when(F.col("table").isNotNull(), F.col("matched") / F.col("n_ref")).alias("score"))


def matched_columns(headers: DataFrame, canon: DataFrame, threshold: float,
                    method: str = "levenshtein") -> DataFrame:
    """(file, table, column): reference columns whose best similarity over the file's
    header names reaches the threshold."""
    good = good_pairs(headers, canon, threshold, method)
    return headers.select("file", "name").join(good, "name").select("file", "table", "column").distinct()


def match_scores(headers: DataFrame, canon: DataFrame, threshold: float = 0.9,
                 method: str = "levenshtein") -> DataFrame:
    """(file, table, score) for every pair with score > 0; score = matched / reference columns."""
    return _file_scores(headers, canon, threshold, method).filter(F.col("table").isNotNull())


def infer_tables(headers: DataFrame, canon: DataFrame, table_order: DataFrame,
                 threshold: float = 0.9, method: str = "levenshtein") -> DataFrame:
    """(file, table, score): best table per file; ties go to the earlier schema; below the
    threshold the table is 'unknown' (score kept).  One aggregate per file (max_by), no sort."""
    scores = _file_scores(headers, canon, threshold, method).join(table_order, "table", "left")
    rank = F.struct(F.coalesce(F.col("score"), F.lit(0.0)).alias("s"), (-F.col("table_pos")).alias("p"))
    best = scores.groupBy("file").agg(F.max_by(F.struct("table", "score"), rank).alias("b"))
    score = F.coalesce(F.col("b.score"), F.lit(0.0))
    return best.select("file", F.when(F.col("b.table").isNotNull() & (score >= F.lit(threshold)), F.col("b.table"))
                       .otherwise(F.lit("unknown")).alias("table"), score.alias("score"))


def pad_to_schema(df: DataFrame, columns: list[str], rename: dict | None = None) -> DataFrame:
    """Rename matched headers to their canonical spelling, then add missing canonical
    columns as nulls; extra columns are kept after the canonical ones."""
    if rename:
        df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns and v not in df.columns})
    present = set(df.columns)
    canon = [F.col(f"`{c}`") if c in present else F.lit(None).cast("string").alias(c) for c in columns]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in set(columns)]
    return df.select(*canon, *extra)


# ---- type reconciliation and merge of versions (M14, M15, U1, U2, U4) ---------------------------

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def resolve_type(types: list[T.DataType]) -> T.DataType:
    """text > double > bigint; dates and timestamps -> timestamp; one other type -> itself;
    anything else -> text."""
    if any(isinstance(t, T.StringType) for t in types):
        return T.StringType()
    if all(isinstance(t, _FRACTIONAL + _INTEGRAL) for t in types):
        if any(isinstance(t, _FRACTIONAL) for t in types):
            return T.DoubleType()
        return T.LongType()
    if all(isinstance(t, _TEMPORAL) for t in types):
        if all(isinstance(t, T.DateType) for t in types):
            return T.DateType()
        if any(isinstance(t, T.TimestampType) for t in types):
            return T.TimestampType()
        return T.TimestampNTZType()
    if all(t == types[0] for t in types):
        return types[0]
    return T.StringType()


def column_order(frames: list[DataFrame]) -> list[str]:
    order: list[str] = []
    for f in frames:
        order += [c for c in f.columns if c not in order]
    return order


def align_versions(frames: list[DataFrame]) -> list[DataFrame]:
    cols = column_order(frames)
    types = {c: resolve_type([f.schema[c].dataType for f in frames if c in f.columns]) for c in cols}
    return [f.select(*[(F.col(f"`{c}`").cast(types[c]) if c in f.columns else F.lit(None).cast(types[c])).alias(c)
                       for c in cols]) for f in frames]


def union_versions(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL after casting every version to the resolved types (absent columns null)."""
    return reduce(lambda a, b: a.unionByName(b), align_versions(frames))


def merge_versions(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL + DISTINCT: one final table from several versions of a staged table."""
    return union_versions(frames).distinct()


def group_by_base_name(names: list[str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for n in names:
        groups.setdefault(n.split(".")[-1], []).append(n)
    return groups


def merge_staged(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Group staged tables by base name (last dotted part) and merge each group."""
    return {base: merge_versions([tables[n] for n in members])
            for base, members in group_by_base_name(list(tables)).items()}


