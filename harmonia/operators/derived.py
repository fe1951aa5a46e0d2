"""The derived tables: coronary-lesion matrix, valve findings, encounter diagnosis flags and
the comorbidity projection.

Plans (see ``explain``):
* lesion_pivot: scan -> broadcast hash join with the 67-row vocabulary (fixed size) ->
  one hash aggregate on study_id with partial (map-side) aggregation, so a hot study costs one
  row per map task in the shuffle.  Conditional max per segment = pivot on a fixed value list,
  no extra distinct pass.
* valve_*: narrow, map-only (Project with higher-order functions); no shuffle.
* encounter_diagnosis: narrow, map-only; code sets are literal arrays (fixed, small).  For code
  sets too large to inline, ``encounter_diagnosis_by_join`` explodes codes and uses a broadcast
  equi-join plus one aggregation keyed on the encounter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lookups as L
from ..functions import codes as C
from ..functions import valve as V


def lesion_lookup(spark: SparkSession) -> DataFrame:
    return L.lookup_df(spark, L.lesion_lookup_rows(), "code string, segment string, seg_pos int")


def lesion_pivot(lesions: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """subject_id, procedure_date, study_id, lesion, stenosis -> one row per study with the
    highest stenosis per coronary segment (0 when absent).  Unmapped lesion codes are dropped;
    a study with no mapped lesion disappears."""
    spark = lesions.sparkSession
    lookup = lookup if lookup is not None else lesion_lookup(spark)
    segments = list(L.LESION_SEGMENTS)
    mapped = (lesions.select("subject_id", "procedure_date", "study_id", "lesion", "stenosis")
              .join(lookup.select("code", "segment"), F.col("lesion") == F.col("code")))
    aggs = [F.max("subject_id").alias("subject_id"), F.max("procedure_date").alias("procedure_date")]
    aggs += [F.max(F.when(F.col("segment") == s, F.col("stenosis"))).alias(s) for s in segments]
    out = mapped.groupBy("study_id").agg(*aggs)
    return (out.na.fill(0, subset=segments)
            .select("subject_id", "procedure_date", "study_id", *[F.col(f"`{s}`") for s in segments]))


def valve_entries(reports: DataFrame, text_col: str = "finaldxcollated",
                  shipped_vocabulary: bool = False) -> DataFrame:
    """Adds ``valve_entries`` (array<struct<key,value>>, last statement wins per key)."""
    cls, raw = "__valve_cls", "__valve_raw"
    return (reports.withColumn(cls, V.classify_statements(F.col(text_col), shipped_vocabulary))
            .withColumn(raw, V.entries_from_classes(cls))
            .withColumn("valve_entries", V.last_wins(raw)).drop(cls, raw))


def valve_map_text(reports: DataFrame, keep=("subject_id", "study_id", "procedure_date"),
                   text_col: str = "finaldxcollated", shipped_vocabulary: bool = False) -> DataFrame:
    """Every report row with its findings as sorted 'key=value;...' text."""
    df = valve_entries(reports, text_col, shipped_vocabulary)
    return df.select(*keep, V.entries_text(F.col("valve_entries")).alias("valve_findings"))


def valve_wide(reports: DataFrame, keys: list[str] | None = None,
               keep=("subject_id", "study_id", "procedure_date", "finaldxcollated"),
               text_col: str = "finaldxcollated", shipped_vocabulary: bool = False) -> DataFrame:
    """Every report row with one column per finding key (the closed key space by default:
    anatomy x (none + valve types) x lesion), value = severity or null."""
    keys = keys or L.valve_key_space(shipped_vocabulary)
    df = valve_entries(reports, text_col, shipped_vocabulary)
    m = F.map_from_entries(F.col("valve_entries"))
    return df.select(*keep, *[F.try_element_at(m, F.lit(k)).alias(k) for k in keys])


def encounter_diagnosis(enc: DataFrame, code_sets: dict | None = None) -> DataFrame:
    """Encounters -> combined codes, one 0/1 flag per diagnosis category (tested against the
    code set of the row's own db_source) and a death flag."""
    code_sets = code_sets or L.DIAGNOSIS_CODE_SETS
    cats = L.diagnosis_categories(code_sets)
    combined = C.combine_codes(F.col("db_source"), F.col("primary_diagnosis"),
                               F.col("secondary_diagnosis"))
    df = enc.withColumn("combined_diagnosis", combined)
    flags = []
    for dx in cats:
        expr = F.lit(0)
        for db, sets in code_sets.items():
            if dx in sets:
                expr = F.when(F.col("db_source") == db,
                              C.has_any_code(F.col("combined_diagnosis"), sets[dx])).otherwise(expr)
        flags.append(expr.alias(dx))
    return df.select("visit_id", "subject_id", "visit_date", "location", "sub_location",
                     "combined_diagnosis", *flags, C.is_death(F.col("visit_outcome")).alias("death"))


def encounter_diagnosis_by_join(enc: DataFrame, code_lookup: DataFrame) -> DataFrame:
    """Same result for code sets too large to inline.  ``code_lookup``: (db_source, dx, code);
    AQE broadcasts it if it is measured small, else sort-merge.  Flags are found once for every distinct
    (db_source, combined codes) and joined back on those, null-safe, so repeated or null visits keep their own."""
    cats = [r[0] for r in code_lookup.select("dx").distinct().orderBy("dx").collect()]
    base = enc.withColumn("combined_diagnosis", C.combine_codes(
        F.col("db_source"), F.col("primary_diagnosis"), F.col("secondary_diagnosis")))
    hits = (base.select("db_source", "combined_diagnosis").distinct()
            .select("db_source", F.col("combined_diagnosis").alias("_codes"), F.explode(F.split("combined_diagnosis", ",")).alias("code"))
            .join(code_lookup, ["db_source", "code"])
            .groupBy(F.col("db_source").alias("_db"), "_codes").pivot("dx", cats).agg(F.max(F.lit(1))))
    out = base.join(hits, F.col("db_source").eqNullSafe(F.col("_db")) & F.col("combined_diagnosis").eqNullSafe(F.col("_codes")), "left")
    return out.select("visit_id", "subject_id", "visit_date", "location", "sub_location",
                      "combined_diagnosis", *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in cats],
                      C.is_death(F.col("visit_outcome")).alias("death"))


def comorbidities(patient: DataFrame) -> DataFrame:
    cols = [c for dx in L.COMORBIDITIES for c in (dx, f"{dx}_onset")]
    return patient.select(F.col("mrn_sha1").alias("subject_id"), *cols)
