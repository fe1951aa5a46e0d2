"""Stage functions: raw folder -> staged -> cleaned -> derived -> final tables.

Layout below ``root`` (shared storage, e.g. a folder under spark.checkpoint.dir or a lake path):

  log/                         commit log: which folder holds the rows of which source now (sources.versions)
  staged/<table>/<part>/       preprocessed rows of one raw file
  clean/<destination>/<part>/  cleaned rows of one raw file
  derived/<name>/<part>/       lesion matrix, valve findings, encounter diagnosis
  final/<table>/<part>/_bucket=<n>/   merged, typed, deduplicated rows with their support

A stage writes new folders and names them in the log by one commit, so a re-run, a retried task, a lost
executor or a run that dies half-way never duplicates, mixes or loses rows.  An input is skipped if its current
entry was made from the same things; one that changed, moved to another table or went withdraws the rows it had given.
The driver handles only metadata: file lists, headers, log entries; all row work runs in Spark jobs.
"""

from __future__ import annotations

import hashlib
import json
import logging
import random
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lookups as L
from ..operators import derived as X
from ..operators.deid import drop_phi, redact_strings
from ..operators.rows import dedup
from ..operators.schema import (align_versions, best_renames, canonical_schema, infer_tables, pad_to_schema,
                                union_versions, unmapped_files)
from ..operators.support import BUCKET, SUPPORT, bucketed, count_rows, supported
from ..sources.files import manifest, read_raw
from ..sources.ledger import select_tables
from ..sources.records import column_names, headers, parsed, records
from ..sources.versions import CommitConflict, CommitLog, part_folder, qualified
from .cleaners import CLEANERS, IECG_TIME, MUSE_TIME, Context, clean, parse_iecg_time, parse_muse_time

log = logging.getLogger(__name__)

STAGED, CLEANED, DERIVED, MERGED, BUCKETS_OF = "staged", "clean", "derived", "merged", "final"
#: Numbers the files whose rows are staged by one write.
PART_OF = "_harmonia_part"
CHANGED = "stage string, source string, tablename string, key string, rowcount long, path string"


def _rows(spark: SparkSession, entries: list[tuple]) -> DataFrame:
    return spark.createDataFrame(entries, CHANGED)


def _gone(spark: SparkSession, sources: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(sources, "stage string, source string")


def _entries(commits: CommitLog, stage: str, schema_part: str | None = None, name_part: str | None = None) -> list:
    """The current entries of a stage, for chosen schemas and tables, by source."""
    return sorted(select_tables(commits.entries(stage), schema_part, name_part).collect(), key=lambda r: r["source"])


def _digest(*made_from: str) -> str:
    return hashlib.sha256(json.dumps(made_from).encode()).hexdigest()


def _header_rows(spark: SparkSession, named: list[tuple]) -> DataFrame:
    rows = [(f["filename"], f["stem"], rank, i, c) for rank, (f, names) in enumerate(named) for i, c in enumerate(names)]
    return spark.createDataFrame(rows, "file string, stem string, file_rank int, pos int, name string")


def _headers(spark: SparkSession, files: list) -> DataFrame:
    return _header_rows(spark, [(f, read_raw(spark, f["path"], f["ext"]).columns) for f in files])


def build_canonical_schema(spark: SparkSession, raw_folder: str, aliases: dict[str, str] | None = None) -> dict[str, list[str]]:
    """Canonical schema {table: ordered columns} from the headers of every raw file and the
    file-name alias map; fails when a file has no canonical table (M1, M2)."""
    aliases = aliases or L.RAW_TABLE_ALIASES
    files = manifest(spark, raw_folder).orderBy("filename").collect()
    hdr = _headers(spark, files)
    al = spark.createDataFrame(list(aliases.items()), "stem string, table string")
    missing = unmapped_files(hdr.select("file", "stem").distinct(), al, key="stem").collect()
    if missing:
        raise ValueError(f"files without a canonical table: {sorted(r['file'] for r in missing)}")
    out: dict[str, list[str]] = {}
    for r in canonical_schema(hdr, al, key="stem").orderBy("table", "pos").collect():
        out.setdefault(r["table"], []).append(r["column"])
    return out


def infer_headers(spark: SparkSession, named: list[tuple[str, list[str]]], known_schemas: dict[str, list[str]],
                  threshold: float, method: str) -> dict[str, tuple[str, float]]:
    """(table, score) of every (file, column names); a file without a column has none."""
    hdr = spark.createDataFrame([(f, i, c) for f, names in named for i, c in enumerate(names)], "file string, pos int, name string")
    canon = spark.createDataFrame([(t, ti, i, c) for ti, (t, cols) in enumerate(known_schemas.items()) for i, c in enumerate(cols)],
                                  "table string, table_pos int, pos int, column string")
    order = spark.createDataFrame([(t, i) for i, t in enumerate(known_schemas)], "table string, table_pos int")
    return {r["file"]: (r["table"], r["score"]) for r in infer_tables(hdr, canon, order, threshold, method).collect()}


def prepared(df: DataFrame, table: str, columns: list[str], known_schemas: dict[str, list[str]],
             threshold: float, method: str, phi: dict | None = None) -> DataFrame:
    """Rows of an export with header ``columns`` as they are staged: fuzzy matches renamed, identifying columns dropped, ids redacted,
    padded to the canonical columns."""
    df = df.withColumnsRenamed(best_renames(columns, known_schemas[table], df.sparkSession, threshold, method))
    dropped = set((phi or L.PHI_COLUMNS).get(table) or [])
    canonical = [c for c in known_schemas[table] if c not in dropped]   # dropped PHI stays dropped
    return pad_to_schema(redact_strings(drop_phi(df, table, phi)), canonical)


def preprocess(spark: SparkSession, raw_folder: str, root: str, known_schemas: dict[str, list[str]],
               threshold: float = 0.9, method: str = "ratcliff", phi: dict | None = None,
               checksum_mode: str = "blocks", multiline: bool = True, withdraw_missing: bool = True) -> list[dict]:
    """Ingest new or changed raw files: infer each file's table from its header, rename fuzzy
    matches to the canonical spelling, drop identifying columns, redact ids, pad to the canonical
    schema and stage it.  Returns what was staged (files below the threshold are skipped and stay pending).

    A file that changed replaces the rows it had given, in whatever table they were.  With ``withdraw_missing`` a file
    that is no longer in ``raw_folder`` takes its rows with it; an empty folder raises rather than withdrawing everything.

    The checksum is put together from the blocks of a file (``sources.digests``), whatever its size; ``checksum_mode="content"`` is SHA-256
    for files under 2 GB, ``"metadata"`` takes path, size and modification time without reading.  CSV exports are cut into records block by block, all of
    them at once (``sources.records``); with ``multiline=False`` every line is a record.  Exports of one table and header are written together,
    a folder each; the rows of each must be as many as its records (Q1)."""
    commits = CommitLog(spark, root)
    seen, _ = commits.head()
    man = manifest(spark, raw_folder, checksum_mode=checksum_mode)
    logged = commits.entries(STAGED).select("source", "tablename", F.col("key").alias("logged_key"))
    files = man.join(logged, man["path"] == logged["source"], "full").select(man["path"], "filename", "stem", "ext", "checksum", "source", "logged_key")
    folder = qualified(spark, raw_folder).rstrip("/") + "/"
    changed = files.where(F.col("path").isNotNull() & ~F.col("checksum").eqNullSafe(F.col("logged_key")))
    missing = files.where(F.col("path").isNull() & F.col("source").startswith(folder) & ~F.substring(F.col("source"), len(folder) + 1, 4096).contains("/"))
    todo = changed.orderBy("filename").collect()
    gone = [(STAGED, r["source"]) for r in missing.select("source").collect()] if withdraw_missing else []
    if gone and not man.head(1):
        raise ValueError(f"{raw_folder} holds no file, but {len(gone)} were ingested from it")
    if not todo and not gone:
        return []
    inferred = {}

    def prepare(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
        return prepared(df, table, columns, known_schemas, threshold, method, phi)

    if todo:
        exports = [f["path"] for f in todo if f["ext"] == "csv"]
        # every export that changed is cut into records by the same few jobs, however many they are
        recs = records(spark, exports, quoted_breaks=multiline) if exports else None
        layouts = {r["file"]: r for r in headers(recs).collect()} if exports else {}   # a header a file
        inferred = infer_headers(spark, [(f["filename"], column_names(layouts[f["path"]]["header"]) if f["path"] in layouts else []) if f["ext"] == "csv"
                                         else (f["filename"], read_raw(spark, f["path"], f["ext"]).columns) for f in todo],
                                 known_schemas, threshold, method)
    written, entries = [], []
    alike: dict[tuple, list] = {}   # exports of one table and header are staged together
    for f in todo:
        table, score = inferred.get(f["filename"], ("unknown", 0.0))
        if table == "unknown":  # Q7: no table reaches the threshold; the file stays pending, and gives no rows any more
            log.warning("skipping %s: best table score %.2f is below %.2f", f["filename"], score, threshold)
            gone += [(STAGED, f["path"])] if f["source"] else []
            continue
        if f["ext"] == "csv":
            alike.setdefault((table, layouts[f["path"]]["header"]), []).append(f)
            continue
        df = read_raw(spark, f["path"], f["ext"])
        path = part_folder(STAGED, table)
        n = write_checked(spark, prepare(df, table, df.columns), f"{root}/{path}", f"staged {f['filename']}")
        entries.append((STAGED, f["path"], table, f["checksum"], n, path))
    for (table, header), files_alike in alike.items():
        names = column_names(header)
        first = [(i, f["path"], layouts[f["path"]]["at"]) for i, f in enumerate(files_alike)]
        first = spark.createDataFrame([(i, p, at["block"], at["n"]) for i, p, at in first], f"{PART_OF} int, file string, at_block long, at_n long")
        body = recs.join(first, "file").where(F.struct("block", "n") > F.struct("at_block", "at_n"))
        df = prepare(parsed(body, names, keep=(PART_OF,)), table, names)
        path = part_folder(STAGED, table)
        found = write_parts_checked(spark, df, f"{root}/{path}", {i: layouts[f["path"]]["records"] for i, f in enumerate(files_alike)})
        bare = part_folder(STAGED, table)   # for all exports that are a header alone
        if not all(found.values()):
            spark.createDataFrame([], df.drop(PART_OF).schema).write.parquet(f"{root}/{bare}")
        entries += [(STAGED, f["path"], table, f["checksum"], found[i], f"{path}/{PART_OF}={i}" if found[i] else bare) for i, f in enumerate(files_alike)]
    by_path = {e[1]: e for e in entries}
    for f in todo:
        if f["path"] in by_path:
            _, _, table, checksum, n, _ = by_path[f["path"]]
            written.append({"filename": f["filename"], "tablename": table, "rowcount": n, "checksum": checksum})
    if entries or gone:
        commits.commit(_rows(spark, entries), _gone(spark, gone), seen)
    return written


def write_checked(spark: SparkSession, df: DataFrame, path: str, what: str) -> int:
    """Write ``df`` to ``path`` and check row parity (Q1): the rows counted while writing
    (an Observation, no extra pass over the input) must equal the rows in the written table."""
    from pyspark.sql import Observation
    obs = Observation(f"rows_{abs(hash(path))}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path).count()
    if obs.get["rows"] != written:
        raise ValueError(f"row parity failed for {what}: {obs.get['rows']} rows written, {written} found")
    return written


def write_parts_checked(spark: SparkSession, df: DataFrame, path: str, expected: dict[int, int]) -> dict[int, int]:
    """Write ``df`` to one folder ``PART_OF=<number>`` below ``path`` for each part and check row parity (Q1): the written rows of every
    part must be as many as ``expected`` from counting its records before they were parsed.  Parts without rows get no folder."""
    df.write.mode("append").partitionBy(PART_OF).parquet(path)
    written = spark.read.option("basePath", path).schema(T.StructType([*df.drop(PART_OF).schema, T.StructField(PART_OF, T.IntegerType())])).parquet(path)
    found = {r[PART_OF]: r["count"] for r in written.groupBy(PART_OF).count().collect()}
    wrong = {i: (n, found.get(i, 0)) for i, n in expected.items() if n != found.get(i, 0)}
    if wrong:
        raise ValueError(f"row parity failed below {path}: (records, rows written) by part {wrong}")
    return {i: found.get(i, 0) for i in expected}


def _read_parts(spark: SparkSession, root: str, paths: list[str]) -> list[DataFrame]:
    """One frame for each schema among the parts: parts that share one are read together."""
    by_schema: dict[str, list[str]] = {}
    for p in paths:
        by_schema.setdefault(spark.read.parquet(f"{root}/{p}").schema.json(), []).append(p)
    return [spark.read.schema(T.StructType.fromJson(json.loads(s))).parquet(*[f"{root}/{p}" for p in ps]) for s, ps in by_schema.items()]


def read_staged(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All staged files of one table, aligned by name (absent columns null; types resolved)."""
    paths = [r["path"] for r in _entries(CommitLog(spark, root), STAGED) if r["tablename"] == table]
    if not paths:
        raise ValueError(f"nothing is staged for {table}")
    return union_versions(_read_parts(spark, root, paths))


# must-parse recording times: date column, time column, parser
ECG_TIMES = {"ecg.iecg": (*IECG_TIME, parse_iecg_time), "ecg.muse": (*MUSE_TIME, parse_muse_time)}


def must_parse_violations(table: str, staged: DataFrame) -> DataFrame | None:
    """Violation rows of the rules the original enforced by raising: unparseable primary codes
    (Q3, Q8) in encounters, unparseable must-parse dates (Q9) in CIS, OHCA, ECG and outpatient
    medication exports."""
    from ..functions import dates as D
    from ..operators.quality import code_violations, date_violations
    cols = set(staged.columns)
    if table == "ehr.encounter":
        return code_violations(staged)
    if table.startswith("cis.") and "Procedure Date" in cols:
        v = F.nullif(F.col("`Procedure Date`").cast("string"), F.lit(L.CIS_DATE_SENTINEL))
        return date_violations(staged.withColumn("_pd", v), "Study Num", "_pd", D.parse_mixed(F.col("_pd")))
    if table == "ccd.ohca" and {"Date of arrival at ED", "Time of arrival at ED"} <= cols:
        arr = F.concat(F.col("`Date of arrival at ED`"), F.lit(" "), D.pad_seconds(F.col("`Time of arrival at ED`")))
        return date_violations(staged.withColumn("_arr", arr), "mrn_sha1", "_arr", D.parse_mixed(F.col("_arr"), True))
    if table in ECG_TIMES and set(ECG_TIMES[table][:2]) <= cols:
        day, time, parse = ECG_TIMES[table]
        at = F.concat_ws(" ", F.col(f"`{day}`"), F.col(f"`{time}`"))
        return date_violations(staged.withColumn("_at", at), "filename" if "filename" in cols else "Filename", "_at", parse(F.col("_at")))
    if table == "ehr.edw_outpatient_medication" and "CREATION_DATE_KEY" in cols:
        start = F.col("CREATION_DATE_KEY").cast("string")
        return date_violations(staged.withColumn("_start", start), "ENC_KEY", "_start", D.parse_mixed(F.col("_start")))
    return None


def clean_stage(spark: SparkSession, root: str, secret: dict, strict: bool = False,
                schema_part: str | None = None, name_part: str | None = None) -> list[str]:
    """Clean every staged file whose input (the file, its table, the secret, and the encounter files where
    the cleaner joins them) is not what its current cleaned rows were made from, and withdraw the rows of files that are no longer
    staged.  Returns the source tables with cleaned files.  ``schema_part`` and ``name_part`` choose tables by parts of
    their names.  With ``strict`` a table with must-parse violations stops the stage (as the original did);
    otherwise the values become null and the violations stay queryable."""
    from ..operators.quality import enforce
    if not secret or not secret.get("salt"):
        raise ValueError("clean_stage needs the pseudonym secret: salt, start_idx, length")
    commits = CommitLog(spark, root)
    seen, _ = commits.head()
    staged = _entries(commits, STAGED)
    chosen = {r["source"] for r in _entries(commits, STAGED, schema_part, name_part)} if schema_part or name_part else {r["source"] for r in staged}
    done = {r["source"]: r for r in _entries(commits, CLEANED)}
    encounters = [f"{r['source']}:{r['key']}" for r in staged if r["tablename"] == "ehr.encounter"]
    ctx = Context(secret=secret)
    if encounters:
        ctx.encounters = read_staged(spark, root, "ehr.encounter").select("visit_id", "mrn_sha1", "encounter_type")
    cleaned, entries = set(), []
    for r in sorted(staged, key=lambda r: (r["tablename"], r["source"])):
        table, spec = r["tablename"], CLEANERS.get(r["tablename"])
        if r["source"] not in chosen:
            continue
        if spec is None:
            log.warning("no cleaner for %s", table)
            continue
        # a late encounter changes what these cleaners return although their own files stay
        key = _digest(table, r["path"], json.dumps(secret, sort_keys=True), *(encounters if spec.joins_encounters else []))
        if r["source"] in done and done[r["source"]]["key"] == key:
            continue
        rows = spark.read.parquet(f"{root}/{r['path']}")
        if strict:
            v = must_parse_violations(table, rows)
            if v is not None:
                enforce(v, f"must-parse values of {table}")
        path = part_folder(CLEANED, spec.target)
        n = write_checked(spark, clean(rows, spec, ctx), f"{root}/{path}", f"cleaned {r['source']}")
        entries.append((CLEANED, r["source"], spec.target, key, n, path))
        cleaned.add(table)
    gone = [(CLEANED, s) for s in done if s not in {r["source"] for r in staged}]
    # a file that now belongs to a table without a cleaner gives no cleaned rows any more
    gone += [(CLEANED, r["source"]) for r in staged if r["source"] in done and CLEANERS.get(r["tablename"]) is None]
    if entries or gone:
        commits.commit(_rows(spark, entries), _gone(spark, gone), seen)
    return sorted(cleaned)


def read_clean(spark: SparkSession, root: str, destination: str) -> DataFrame | None:
    """The distinct cleaned rows of a destination table; None if there is none."""
    paths = [r["path"] for r in _entries(CommitLog(spark, root), CLEANED) if r["tablename"] == destination]
    if not paths:
        return None
    rows = union_versions(_read_parts(spark, root, paths))
    return dedup(rows) if len(paths) > 1 else rows   # one file's cleaned rows are distinct


def _lesion(df: DataFrame) -> DataFrame:
    return X.lesion_pivot(df.withColumn("stenosis", F.col("stenosis").cast("string").try_cast("double")))


# Registered transforms: cleaned table -> (function, derived table name).  Add an entry to derive
# another table; each function is DataFrame -> DataFrame.
TRANSFORMS = {
    "cis.caglesion": (_lesion, "cis.caglesion_pivoted"),
    "cis.echo": (X.valve_wide, "cis.echo_valvelesion"),
    "ehr.encounter": (X.encounter_diagnosis, "ehr.encounter_diagnosis"),
}


def transform_stage(spark: SparkSession, root: str, transforms: dict | None = None,
                    schema_part: str | None = None, name_part: str | None = None) -> list[str]:
    """Derived tables from the cleaned tables that changed since; a derived table whose source has gone goes too.
    Returns the tables made.  Combined diagnosis codes with a '.' left stop the stage (Q4), before anything is committed."""
    from ..operators.quality import code_violations, enforce
    commits = CommitLog(spark, root)
    seen, _ = commits.head()
    parts: dict[str, list[str]] = {}
    for r in _entries(commits, CLEANED, schema_part, name_part):
        parts.setdefault(r["tablename"], []).append(r["path"])
    everything = {r["tablename"] for r in _entries(commits, CLEANED)}
    done = {r["source"]: r["key"] for r in _entries(commits, DERIVED)}
    made, entries, gone = [], [], []
    for source, (fn, name) in (transforms or TRANSFORMS).items():
        if source not in everything:
            gone += [(DERIVED, name)] if name in done else []
            continue
        if source not in parts:   # not chosen
            continue
        key = _digest(name, *sorted(parts[source]))
        if done.get(name) == key:
            continue
        df = read_clean(spark, root, source)
        if source == "ehr.encounter" and {"visit_id", "db_source", "primary_diagnosis", "secondary_diagnosis"} <= set(df.columns):
            enforce(code_violations(df).where("rule = 'Q4_combined_has_dot'"), "Q4: combined codes without '.'")
        path = part_folder(DERIVED, name)
        n = write_checked(spark, fn(df), f"{root}/{path}", f"derived {name}")
        entries.append((DERIVED, name, name, key, n, path))
        made.append(name)
    if entries or gone:
        commits.commit(_rows(spark, entries), _gone(spark, gone), seen)
    return made


def put_part(spark: SparkSession, root: str, stage: str, table: str, source: str, rows: DataFrame, key: str) -> int:
    """Write the rows of one source of ``table`` and commit them in place of what the source gave before; returns their number."""
    commits = CommitLog(spark, root)
    seen, _ = commits.head()
    path = part_folder(stage, table)
    n = write_checked(spark, rows, f"{root}/{path}", f"{stage} {source}")
    commits.commit(_rows(spark, [(stage, source, table, key, n, path)]), seen=seen)
    return n


def add_part(spark: SparkSession, root: str, stage: str, table: str, source: str, rows: DataFrame, key: str, tries: int = 20) -> int | None:
    """As ``put_part`` for a source of its own: None, without reading ``rows``, if it was committed under this key before.  Nothing
    else rests on the log's state, so another writer's commit in between only has this one made again."""
    commits = CommitLog(spark, root)
    if commits.entries(stage).where((F.col("source") == source) & F.col("key").eqNullSafe(key)).head(1):
        return None
    path = part_folder(stage, table)
    n = write_checked(spark, rows, f"{root}/{path}", f"{stage} {source}")
    for left in reversed(range(tries)):
        try:
            commits.commit(_rows(spark, [(stage, source, table, key, n, path)]))
            return n
        except CommitConflict:
            if not left:
                raise
            time.sleep(random.random())


#: Rows of a final table that share a bucket, about.  A table is dealt anew once its buckets hold four times as many.
BUCKET_ROWS = 2_000_000


def _buckets_for(rows: int) -> int:
    return 8 << max(0, (max(1, rows) // (8 * BUCKET_ROWS)).bit_length())


def _aligned(spark: SparkSession, root: str, paths: list[str], schema: T.StructType) -> list[DataFrame]:
    """The parts in the final columns and types, a frame per schema among them; a row occurs once for every part that holds it."""
    out = []
    for df in _read_parts(spark, root, paths):
        have = {f.name: f.dataType for f in df.schema}
        cells = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        if any(have.get(f.name, f.dataType) != f.dataType for f in schema):   # a cast may make two rows of a part equal
            part = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
            df = dedup(df.select(*cells, part.alias("_part"))).drop("_part")
        else:
            df = df.select(*cells)
        out.append(df)
    return out


def merge_table(spark: SparkSession, root: str, commits: CommitLog, table: str, parts: list[str],
                buckets: int | None = None) -> tuple[list, list, bool]:
    """Bring the final rows of ``table`` up to the distinct union of ``parts`` (folders of distinct rows, relative to the root).

    Reads the parts that came or went since the last merge and the buckets their rows fall into.  If the resolved
    columns or types or the number of buckets changed, or nothing was merged yet, all parts are read.  Returns (entries, gone,
    whether all was made anew) for the caller's commit; ([], [], False) if nothing changed.
    """
    merged = [r for r in _entries(commits, MERGED) if r["tablename"] == table]
    held = [r for r in _entries(commits, BUCKETS_OF) if r["tablename"] == table]
    before, now = {r["path"] for r in merged}, set(parts)
    added, withdrawn = sorted(now - before), sorted(before - now)
    keys = {r["key"] for r in merged + held}
    if not added and not withdrawn and None not in keys:   # a cleared key asks for the table to be made anew
        return [], [], False
    if not now:
        return [], [(r["stage"], r["source"]) for r in merged + held], True
    schema = align_versions(_read_parts(spark, root, sorted(now)))[0].schema
    shape = _digest(json.dumps(sorted((f.name, f.dataType.simpleString()) for f in schema)))
    rows = sum(r["rowcount"] for r in held)
    if len(keys) == 1 and None not in keys and next(iter(keys)).split(":")[1] == shape:
        dealt = int(next(iter(keys)).split(":")[0])
        rebuild = buckets not in (None, dealt) or (buckets is None and rows > 4 * BUCKET_ROWS * dealt)
    else:
        rebuild = True
    if rebuild:
        sizes = {r["path"]: r["rowcount"] for r in _entries(commits, CLEANED)}
        dealt = buckets or _buckets_for(sum(sizes.get(p) or 0 for p in now))
        new, touched = bucketed(count_rows(_aligned(spark, root, sorted(now), schema), []), dealt), [r["source"] for r in held]
    else:
        change = bucketed(count_rows(_aligned(spark, root, added, schema), _aligned(spark, root, withdrawn, schema)), dealt)
        staging = f"{root}/{part_folder('change', table)}"
        change.write.parquet(staging)
        change = spark.read.schema(change.schema).parquet(staging)
        hit = {f"{table}#{r[BUCKET]}" for r in change.select(BUCKET).distinct().collect()}   # as many as there are buckets at most
        old = [r for r in held if r["source"] in hit]
        touched, of = [r["source"] for r in old], T.StructType([*schema, T.StructField(SUPPORT, T.LongType())])
        new = change
        if old:   # equal rows share a bucket, so its number need not be in the files
            new = supported(bucketed(spark.read.schema(of).parquet(*[f"{root}/{r['path']}" for r in old]), dealt), change)
    path = part_folder("final", table)
    new.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/{path}")
    of = T.StructType([*schema, T.StructField(SUPPORT, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    sizes = spark.read.schema(of).parquet(f"{root}/{path}").groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.min(SUPPORT).alias("least")).collect()
    if any(r["least"] < 0 for r in sizes):
        raise ValueError(f"rows of {table} were withdrawn that had not been merged")
    key = f"{dealt}:{shape}"
    entries = [(BUCKETS_OF, f"{table}#{r[BUCKET]}", table, key, r["rows"], f"{path}/{BUCKET}={r[BUCKET]}") for r in sizes]
    rewritten = {e[1] for e in entries}
    entries += [(MERGED, f"{table}|{p}", table, key, None, p) for p in (sorted(now) if rebuild else added)]
    gone = [(BUCKETS_OF, s) for s in touched if s not in rewritten] + [(MERGED, f"{table}|{p}") for p in withdrawn]
    return entries, gone, rebuild


def merge_stage(spark: SparkSession, root: str, schema_part: str | None = None, name_part: str | None = None,
                buckets: int | None = None) -> list[str]:
    """Final tables: all cleaned parts of a table, cast to the resolved types, as a distinct union with support counts,
    brought up to date by what changed.  A derived table has one part of distinct rows and is final as it is.
    Returns the tables that changed."""
    commits = CommitLog(spark, root)
    seen, _ = commits.head()
    parts: dict[str, list[str]] = {r["tablename"]: [] for stage in (MERGED,) for r in _entries(commits, stage, schema_part, name_part)}
    for r in _entries(commits, CLEANED, schema_part, name_part):
        parts.setdefault(r["tablename"], []).append(r["path"])
    entries, gone, changed = [], [], []
    for table in sorted(parts):
        e, g, _ = merge_table(spark, root, commits, table, parts[table], buckets)
        entries, gone, changed = entries + e, gone + g, changed + ([table] if e or g else [])
    if entries or gone:
        commits.commit(_rows(spark, entries), _gone(spark, gone), seen)
    return changed


def final_tables(spark: SparkSession, root: str) -> list[str]:
    commits = CommitLog(spark, root)
    return sorted({r["tablename"] for stage in (BUCKETS_OF, DERIVED) for r in commits.entries(stage).select("tablename").distinct().collect()})


def read_final(spark: SparkSession, root: str, table: str, with_support: bool = False) -> DataFrame:
    """The rows of a final (or derived) table as of the newest commit; ``with_support`` adds in how many parts each occurs."""
    commits = CommitLog(spark, root)
    derived = [r["path"] for r in _entries(commits, DERIVED) if r["tablename"] == table]
    if derived:
        return spark.read.parquet(f"{root}/{derived[0]}")
    paths = [r["path"] for r in _entries(commits, BUCKETS_OF) if r["tablename"] == table]
    if not paths:
        raise ValueError(f"there is no final table {table}")
    rows = spark.read.parquet(*[f"{root}/{p}" for p in paths])
    return rows if with_support else rows.drop(SUPPORT)


def purge(spark: SparkSession, root: str, name_part: str, stages: tuple[str, ...] | None = None, schema_part: str | None = None) -> int:
    """Have the next run process the tables whose names contain ``name_part`` anew (S13); their rows stay until then."""
    return CommitLog(spark, root).forget(name_part, stages, schema_part)
