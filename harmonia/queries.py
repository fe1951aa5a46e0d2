"""Driver queries: each builds clinical-shaped input from the supplied tables with
deterministic expressions (the same expressions are written in DuckDB SQL in ``oracle.py``),
then runs one library operator over the whole input.

Modulo arithmetic on keys picks values (a code, a unit, a spelling) and, in the merge query,
splits one table into versions so that every row lands in one of them.  It never drops rows from
the work: every query processes whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lookups as L

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A supplied table.

    The supplied files are single parquet row groups, so a scan is one task however many cores
    there are.  When a scan has fewer partitions than the default parallelism, the rows are
    spread round-robin so per-row work before the first shuffle (parsing, hashing) uses every
    core (not with ``spread=False``, for light per-row work).  Inputs made of many files or row groups (any real deployment)
    are left as scanned.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def pick(expr: Column, values: list) -> Column:
    """values[expr mod n] (expr is a non-negative integer expression)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(expr, F.lit(len(values))) + 1).cast("int"))


# ---- fixtures shared by several queries ---------------------------------------------------------

def lesion_codes() -> list:
    seen = []
    for _, codes in L.LESION_SEGMENTS.items():
        for c in codes:
            if c not in seen:
                seen.append(c)
    return seen + ["XYZ", "pLAD  ", None]


def lesion_input(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", spread=False)   # a lookup join and an aggregate: no spread
    return li.select(
        F.col("l_suppkey").alias("subject_id"),
        F.col("l_shipdate").alias("procedure_date"),
        F.col("l_orderkey").alias("study_id"),
        pick(F.col("l_partkey") + F.col("l_linenumber"), lesion_codes()).alias("lesion"),
        F.col("l_quantity").alias("stenosis"),
    )


# ---- derived tables -----------------------------------------------------------------------------

@register
def q_lesion_pivot(spark, sf_dir):
    from .operators.derived import lesion_pivot
    return lesion_pivot(lesion_input(spark, sf_dir))


VALVE_STATEMENTS = [
    "Severe aortic stenosis", "Mild mitral regurgitation",
    "Mild to moderate aortic and mitral regurg", "Aortic stenosis",
    "Mechanical mitral valve; severe stenosis", "Trivial tricuspid regurgitation",
    "Moderate pulmonic regurgitation", "Bioprosthesis in aortic position with mild stenosis",
    "TAVI aortic valve, trivial regurgitation", "Mitral valve prolapse, moderate",
    "Bicuspid aortic valve with mild stenosis", "Severe mitral annular calcification",
    "Normal LV function", "MitraClip in situ with mild mitral regurgitation",
    "Systolic anterior motion of mitral valve - moderate", "Vegetation on tricuspid valve, severe",
    "Aortic-mitral mass mild", "same as before, moderate mitral_regurg",
    "St Jude aortic, tricuspid and pulmonary regurg severe", "Corevalve aortic stenosis mild",
]
VALVE_SEPARATORS = [". ", "¤", "§", " and "]


def valve_input(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat(pick(k, VALVE_STATEMENTS), pick(c, VALVE_SEPARATORS),
                    pick(k + c, VALVE_STATEMENTS + [""]), pick(k * 7, VALVE_SEPARATORS),
                    pick(c * 3 + k, VALVE_STATEMENTS + ["", ""]))
    text = F.when(F.pmod(k, F.lit(23)) == 0, F.lit(None)).otherwise(
        F.when(F.pmod(k, F.lit(5)) == 0, F.upper(text)).otherwise(text))
    return o.select(c.alias("subject_id"), k.alias("study_id"),
                    F.col("o_orderdate").alias("procedure_date"), text.alias("finaldxcollated"))


@register
def q_valve_map(spark, sf_dir):
    from .operators.derived import valve_map_text
    return valve_map_text(valve_input(spark, sf_dir))


@register
def q_valve_wide(spark, sf_dir):
    from .operators.derived import valve_wide
    return valve_wide(valve_input(spark, sf_dir))


VISIT_OUTCOMES = ["Death Coroners", "Discharged", "Deceased", None, "Home", "Death Non-Coroners",
                  "Transferred"]


def encounter_input(spark, sf_dir) -> DataFrame:
    """Raw encounters: one per order; visit ids 'edw_<n>' / 'hosp_<n>'."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    db = (F.when(F.pmod(k, F.lit(11)) == 0, F.lit("legacy"))
          .when(F.pmod(k, F.lit(2)) == 0, F.lit("dts")).otherwise(F.lit("edw")))
    edw = db == "edw"
    prim = F.pmod(c, F.lit(60)).cast("string")
    prim = F.when(F.pmod(c, F.lit(13)) == 0, F.lit(None)).otherwise(
        F.when(edw & (F.pmod(k, F.lit(3)) == 0), F.concat(prim, F.lit(".0"))).otherwise(prim))
    sec = F.concat(F.pmod(k, F.lit(55)).cast("string"), F.lit(","), F.pmod(c, F.lit(50)).cast("string"))
    sec = F.when(F.pmod(k, F.lit(7)) == 0, F.lit(None)).otherwise(
        F.when(edw, F.concat(F.pmod(k, F.lit(55)).cast("string"), F.lit(".0,"),
                             F.pmod(c, F.lit(50)).cast("string"), F.lit(".0"))).otherwise(sec))
    visit = F.concat(F.when(edw, F.lit("edw_")).otherwise(F.lit("hosp_")), k.cast("string"))
    return o.select(
        visit.alias("visit_id"), F.concat(F.lit("mrn_"), c.cast("string")).alias("mrn_sha1"),
        pick(k, ["IP", "OP", "AE", "DS", "Inpatient visit", "Emergency", "ward"]).alias("encounter_type"),
        db.alias("db_source"), prim.alias("primary_diagnosis"), sec.alias("secondary_diagnosis"),
        F.col("o_orderdate").alias("visit_date"), F.col("o_orderpriority").alias("location"),
        F.col("o_orderstatus").alias("sub_location"), pick(k, VISIT_OUTCOMES).alias("visit_outcome"))


@register
def q_dx_flags(spark, sf_dir):
    from .operators.derived import encounter_diagnosis
    enc = encounter_input(spark, sf_dir).withColumnRenamed("mrn_sha1", "subject_id")
    return encounter_diagnosis(enc)


@register
def q_dx_flags_join(spark, sf_dir):
    """Same flags through the path for code sets too large to inline: exploded codes, an
    equi-join with the (db_source, dx, code) lookup and one aggregation per visit."""
    from .operators.derived import encounter_diagnosis_by_join
    enc = encounter_input(spark, sf_dir).withColumnRenamed("mrn_sha1", "subject_id")
    lookup = L.lookup_df(spark, L.diagnosis_lookup_rows(), "db_source string, dx string, code string")
    return encounter_diagnosis_by_join(enc, lookup)


def patient_input(spark, sf_dir) -> DataFrame:
    """Raw patient export (33 columns) derived from customer."""
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    cols = [
        F.concat(F.lit("mrn_"), k.cast("string")).alias("mrn_sha1"),
        F.concat(F.lit("19"), F.lpad((F.pmod(k, F.lit(70)) + 20).cast("string"), 2, "0"), F.lit("-0"),
                 (F.pmod(k, F.lit(9)) + 1).cast("string"), F.lit("-1"),
                 F.pmod(k, F.lit(10)).cast("string")).alias("dob"),
        pick(k, ["F", "M", "U", "1", "2", "X", None]).alias("gender"),
        F.when(F.pmod(k, F.lit(9)) == 0, F.lit("2021-06-01")).when(F.pmod(k, F.lit(9)) == 1, F.lit("junk"))
         .alias("death_indicator"),
        pick(k * 3, ["C", "CA", "CN", "EU", "I", "IN", "M", "MY", "N", "O", "S", "SK", "XX", "ZZ"])
         .alias("ethnicity_race"),
        F.concat(F.lit("2015-0"), (F.pmod(k, F.lit(9)) + 1).cast("string"), F.lit("-01")).alias("first_followup_dt"),
        F.concat(F.lit("03/"), F.lpad((F.pmod(k, F.lit(28)) + 1).cast("string"), 2, "0"), F.lit("/2022"))
         .alias("last_followup_dt"),
        pick(k, ["dts", "edw"]).alias("db_source"),
        F.col("c_mktsegment").alias("last_encounter_location"),
    ]
    for i, dx in enumerate(L.COMORBIDITIES):
        flag = F.pmod(k + i, F.lit(2)).cast("string")
        onset = F.when(flag == "1", F.concat(F.lit("2020-"), F.lpad((F.pmod(k + i, F.lit(12)) + 1).cast("string"), 2, "0"),
                                               F.lit("-15")))
        cols += [flag.alias(dx), onset.alias(f"{dx}_onset")]
    return cu.select(*cols)


@register
def q_comorbidity(spark, sf_dir):
    from .operators.derived import comorbidities
    return comorbidities(patient_input(spark, sf_dir))


# ---- column functions ---------------------------------------------------------------------------

MED_TYPE_TEXTS = ["IP", "Inpatient", "discharge", "Discharge summary", "AE", "Emergency dept", "DS",
                  "OP clinic", "Outpatient", "ward", None, "OPD|IP", "day surgery"]


@register
def q_med_type(spark, sf_dir):
    from .functions.text import medication_class
    o = table(spark, sf_dir, "orders")
    raw = pick(F.col("o_orderkey") + F.col("o_custkey"), MED_TYPE_TEXTS)
    return o.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", medication_class(F.col("raw")).alias("medication_type"))


TOKEN_TEXTS = ["IP|OP|IP", "AE", "DS|DS", "OP|AE|IP|AE", "", "x||y", "Discharge|IP", None]


@register
def q_unique_tokens(spark, sf_dir):
    from .functions.text import unique_tokens
    o = table(spark, sf_dir, "orders")
    raw = F.concat_ws("|", pick(F.col("o_orderkey"), TOKEN_TEXTS), F.col("o_orderstatus"),
                      pick(F.col("o_custkey"), TOKEN_TEXTS))
    return o.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", unique_tokens(F.col("raw")).alias("medication_type"))


DURATION_UNITS = ["days", "weeks", "Months", "menstrual cycle", "day", "week", "calendar month",
                  "mens cycle", "days per cycle", "fortnight"]


def duration_text(k, c):
    amount = F.pmod(k, F.lit(14)).cast("string")
    txt = F.concat(amount, F.lit(" "), pick(c, DURATION_UNITS))
    return (F.when(F.pmod(k, F.lit(17)) == 0, F.lit(None))
            .when(F.pmod(k, F.lit(13)) == 0, pick(c, L.CYCLE_RANGES))
            .when(F.pmod(k, F.lit(11)) == 0, F.concat(amount, F.lit("days")))
            .otherwise(txt))


@register
def q_split_unit(spark, sf_dir):
    from .functions.text import split_first_space
    o = table(spark, sf_dir, "orders")
    raw = duration_text(F.col("o_orderkey"), F.col("o_custkey"))
    amount, unit = split_first_space(F.col("raw"))
    return o.select("o_orderkey", raw.alias("raw")).select("o_orderkey", "raw", amount.alias("amount"),
                                                           unit.alias("unit"))


DOSE_TEXTS = ["2.5 mg", "500mg", "abc", "10 units", "1,000 mg OM", "5", "x2y3z", None, "0.5ml",
              "tab 2 x 250 mg", "", "12.25 mcg/hr"]


def dose_text(k, size):
    return F.when(F.pmod(k, F.lit(3)) == 0, F.concat(size.cast("string"), F.lit(" mg"))).otherwise(
        pick(k, DOSE_TEXTS))


@register
def q_last_number(spark, sf_dir):
    from .functions.text import split_last_number
    p = table(spark, sf_dir, "part")
    raw = dose_text(F.col("p_partkey"), F.col("p_size"))
    df = p.select("p_partkey", raw.alias("raw"))
    d1, u1 = split_last_number(F.col("raw"), "full")
    d2, u2 = split_last_number(F.col("raw"), "last_run")
    return df.select("p_partkey", "raw", d1.alias("dose"), u1.alias("dose_units"),
                     d2.alias("dose_last_run"), u2.alias("dose_units_last_run"))


CODE_TEXTS = ["123.0", "1e5", None, "12.0,34.0", "10.05,2", "12345678901234567", "abc", "42", " 7 ",
              "-5.5", "0.4", "3.0,4.5", "1.5E2"]


def code_text(k, c):
    return F.when(F.pmod(k, F.lit(3)) == 0, F.concat(c.cast("string"), F.lit(".0"))).otherwise(
        pick(k, CODE_TEXTS))


@register
def q_code_clean(spark, sf_dir):
    from .functions.codes import numeric_code
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", code_text(F.col("o_orderkey"), F.col("o_custkey")).alias("raw")).select(
        "o_orderkey", "raw", numeric_code(F.col("raw")).alias("code"))


def id_text(k):
    d7 = F.lpad(k.cast("string"), 7, "0")
    m = F.pmod(k, F.lit(8))
    return (F.when(m == 0, F.concat(F.lit("S"), d7, F.lit("D")))
            .when(m == 1, F.concat(F.lit("ab"), d7))
            .when(m == 2, F.concat(F.lit("S"), F.lpad(k.cast("string"), 6, "0"), F.lit("D")))
            .when(m == 3, F.concat(F.lit("xS"), d7, F.lit("D")))
            .when(m == 4, F.concat(F.lit("id S"), d7, F.lit("D")))
            .when(m == 5, F.concat(F.lit("T"), F.lpad(k.cast("string"), 8, "0")))
            .when(m == 6, F.concat(F.lit("G"), d7, F.lit("X\n")))
            .otherwise(F.concat(F.lit("abc"), d7)))


@register
def q_redact_id(spark, sf_dir):
    from .operators.deid import redact_strings
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    df = cu.select(k, id_text(k).alias("nric"), F.col("c_name"), F.col("c_mktsegment"),
                   F.col("c_acctbal"))
    return redact_strings(df)


@register
def q_pseudonym(spark, sf_dir):
    from .functions.deid import file_stem, pseudonym
    cu = table(spark, sf_dir, "customer")
    s = L.TEST_SECRET
    fname = F.concat(F.lit("D:\\ecg\\export\\"), F.col("c_name"), F.lit(".xml"))
    name = F.when(F.pmod(F.col("c_custkey"), F.lit(10)) == 0, F.lit(None)).otherwise(F.col("c_name"))
    return cu.select(
        "c_custkey",
        pseudonym(name, s["salt"], s["start_idx"], s["length"]).alias("name_hash"),
        pseudonym(file_stem(fname), s["salt"], s["start_idx"], 30).alias("study_id"))


def cis_raw(spark, sf_dir) -> DataFrame:
    """A raw CIS export (cis.cag shape) derived from orders: ids, dates with a sentinel, a
    hospital alias column, operational ids and identifying free-text columns."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    date = F.when(F.pmod(k, F.lit(19)) == 0, F.lit(L.CIS_DATE_SENTINEL)).otherwise(
        F.when(F.pmod(k, F.lit(2)) == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    return o.select(
        F.concat(F.lit("mrn_"), c.cast("string")).alias("IDRef"),
        F.concat(F.lit("ST"), k.cast("string")).alias("Study Num"),
        date.alias("Procedure Date"),
        F.col("o_orderpriority").alias("Proc_HospitalID"),
        pick(k, ["CAG", "PCI", "Echo", "Nuclear"]).alias("Procedure2"),
        F.concat(F.lit("rf"), k.cast("string")).alias("RF_IDRef"),
        F.lit("N").alias("VIP"),
        pick(c, ["R1", "R2", ""]).alias("ResCode"),
        F.concat(F.lit("Patient S"), F.lpad(c.cast("string"), 7, "0"), F.lit("A seen")).alias("Comments"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Case Closed Date"),
        F.lit("<html/>").alias("HTML"),
        pick(k, ["Nurse A", "Nurse B"]).alias("ScrubNurse1"),
        F.concat(F.lit("S"), F.lpad(c.cast("string"), 7, "0"), F.lit("Z")).alias("Radiographer"),
        F.col("o_totalprice").alias("Contrast Volume"),
        F.col("o_orderstatus").alias("Outcome"),
    )


@register
def q_drop_phi(spark, sf_dir):
    from .operators.deid import drop_columns, drop_phi, redact_strings
    df = drop_phi(cis_raw(spark, sf_dir), "cis.cag")
    return redact_strings(drop_columns(df, L.CIS_DROP_COLUMNS))


@register
def q_recode(spark, sf_dir):
    from .operators.rows import recode_columns
    p = patient_input(spark, sf_dir)
    route = pick(F.col("c_custkey"), ["PO", "IV", "SC", "NG", "IM", "PR", None]).alias("route")
    cu = table(spark, sf_dir, "customer").select("c_custkey", route)
    df = p.join(cu, F.col("mrn_sha1") == F.concat(F.lit("mrn_"), F.col("c_custkey").cast("string")))
    df = df.select("mrn_sha1", "gender", "ethnicity_race", "route")
    return recode_columns(df, {"gender": L.GENDER_RECODE, "ethnicity_race": L.ETHNICITY_RECODE,
                               "route": L.ROUTE_RECODE})


@register
def q_sentinel_null(spark, sf_dir):
    from .operators.rows import sentinel_to_null
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    df = ev.select(
        k, pick(k, ["37.1", "", '""""', "36.8", None]).alias("temperature"),
        pick(k * 3, ["degC", '""""', ""]).alias("temperature_uom"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit("")).otherwise(F.col("event_type")).alias("o2_device"),
        F.col("value"))
    return sentinel_to_null(df)


@register
def q_coalesce(spark, sf_dir):
    from .operators.rows import coalesce_from, first_non_missing
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    df = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None)).otherwise(F.concat(F.lit("drug "), k.cast("string")))
         .alias("medication_name"),
        F.concat(F.lit("Take "), F.col("l_quantity").cast("int").cast("string"), F.lit(" mg")).alias("instruction"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.col("l_quantity")).alias("dose_a"),
        F.when(F.pmod(k, F.lit(5)) == 0, F.col("l_tax")).alias("dose_b"),
        F.col("l_discount").alias("dose_c"))
    df = coalesce_from(df, "medication_name", "instruction")
    return first_non_missing(df, {"dose": ["dose_a", "dose_b", "dose_c"]})


@register
def q_drop_all_null(spark, sf_dir):
    from .operators.rows import drop_all_null
    o = table(spark, sf_dir, "orders")
    empty = F.pmod(F.col("o_orderkey"), F.lit(10)) == 0
    part = F.pmod(F.col("o_orderkey"), F.lit(10)) == 1
    df = o.select(*[F.when(empty | (part & F.lit(c != "o_orderstatus")), F.lit(None)).otherwise(F.col(c)).alias(c)
                    for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]])
    return drop_all_null(df)


@register
def q_dedup(spark, sf_dir):
    from .operators.rows import dedup, union_all
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return dedup(union_all([o, o.filter(F.col("o_orderstatus") == "F")]))


def formatted_ts(ts, k):
    """A timestamp written in one of several spellings chosen by key, plus junk and nulls."""
    m = F.pmod(k, F.lit(20))
    return (F.when(m == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(m == 1, F.date_format(ts, "MM/dd/yyyy"))
            .when(m == 2, F.date_format(ts, "d/M/yyyy H:mm"))
            .when(m == 3, F.date_format(ts, "yyyyMMdd"))
            .when(m == 4, F.lit("junk"))
            .when(m == 5, F.date_format(ts, "dd/MM/yyyy"))
            .when(m == 6, F.date_format(ts, "yyyy-MM-dd"))
            .when(m == 7, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .when(m == 8, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(m == 9, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+08:00'"))
            .when(m == 10, F.date_format(ts, "dd-MMM-yyyy"))
            .when(m == 11, F.date_format(ts, "d MMM yyyy HH:mm"))
            .when(m == 12, F.date_format(ts, "MMMM d, yyyy"))
            .when(m == 13, F.date_format(ts, "MM/dd/yy"))
            .when(m == 14, F.date_format(ts, "MM/dd/yyyy hh:mm a"))
            .when(m == 15, F.date_format(ts, "yyyy/MM/dd"))
            .when(m == 16, F.date_format(ts, "yyyyMMddHHmmss"))
            .when(m == 17, F.concat(F.lit(" "), F.date_format(ts, "d/M/yyyy"), F.lit("  "), F.date_format(ts, "H:mm:ss")))
            .otherwise(F.lit(None)))


@register
def q_date_coerce(spark, sf_dir):
    from .functions.dates import parse_exact, parse_mixed
    ev = table(spark, sf_dir, "events")
    raw = formatted_ts(F.col("ts"), F.col("event_id"))
    return ev.select("event_id", raw.alias("raw")).select(
        "event_id", "raw", parse_mixed(F.col("raw")).alias("parsed"),
        parse_exact(F.col("raw"), "yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$").alias("parsed_exact"))


@register
def q_date_mixed(spark, sf_dir):
    from .functions.dates import parse_mixed
    o = table(spark, sf_dir, "orders")
    raw = formatted_ts(F.col("o_orderdate") + F.expr("INTERVAL 7 HOURS"), F.col("o_orderkey") + F.col("o_custkey"))
    return o.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", parse_mixed(F.col("raw")).alias("month_first"),
        parse_mixed(F.col("raw"), dayfirst=True).alias("day_first"))


@register
def q_date_shapes(spark, sf_dir):
    """Shapes of the exported date spellings and of free notes, with how many values of each the parser reads."""
    from .operators.shapes import date_shapes
    o = table(spark, sf_dir, "orders")
    raw = formatted_ts(F.col("o_orderdate") + F.expr("INTERVAL 7 HOURS"), F.col("o_orderkey") + F.col("o_custkey"))
    return date_shapes(o.select(raw.alias("exported"), F.col("o_orderpriority").alias("priority")), ["exported", "priority"])


ARRIVAL_TIMES = ["9:05", "09:05:10", "23:59", None, "7:3", "12:00:00"]


@register
def q_arrival_dt(spark, sf_dir):
    from .functions.dates import pad_seconds, parse_mixed
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    df = o.select(k, F.date_format("o_orderdate", "dd/MM/yyyy").alias("arrival_date"),
                  pick(k, ARRIVAL_TIMES).alias("arrival_time"),
                  formatted_ts(F.col("o_orderdate"), F.col("o_custkey")).alias("discharge"))
    df = df.withColumn("arrival_time", pad_seconds(F.col("arrival_time")))
    return df.select(k, "arrival_time",
                     parse_mixed(F.concat("arrival_date", F.lit(" "), "arrival_time"), dayfirst=True).alias("arrival_dt"),
                     parse_mixed(F.col("discharge"), dayfirst=True).alias("date_of_discharge_or_death"))


@register
def q_ecg_time(spark, sf_dir):
    from .functions.dates import parse_exact
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    d = F.when(F.pmod(k, F.lit(29)) == 0, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    t = F.date_format("ts", "HH:mm:ss")
    md = F.date_format("ts", "MM-dd-yyyy")
    return ev.select(
        k, parse_exact(F.concat_ws(" ", d, t), "yyyy-MM-dd HH:mm:ss",
                       r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$").alias("iecg_time"),
        parse_exact(F.concat_ws(" ", md, t), "MM-dd-yyyy HH:mm:ss",
                    r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$").alias("muse_time"))


@register
def q_day_diff(spark, sf_dir):
    from .functions.dates import floor_day_diff
    li = table(spark, sf_dir, "lineitem")
    hours = F.col("l_linenumber") * 7 - 20 + F.pmod(F.col("l_partkey"), F.lit(50))
    end = F.timestamp_add("HOUR", hours, F.col("l_shipdate"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("start_dt"),
                     end.alias("end_dt")).withColumn("duration", floor_day_diff("end_dt", "start_dt"))


@register
def q_end_date(spark, sf_dir):
    from .functions.dates import add_days
    from .functions.text import split_first_space
    o = table(spark, sf_dir, "orders")
    raw = F.lower(duration_text(F.col("o_orderkey"), F.col("o_custkey")))
    amount, unit = split_first_space(F.col("raw"))
    n = (F.when(F.col("amount").isin(*L.CYCLE_RANGES), F.lit(1.0)).otherwise(F.col("amount").try_cast("double"))
         * _unit_days(F.col("unit")))
    df = (o.select("o_orderkey", F.col("o_orderdate").alias("start_dt"), raw.alias("raw"))
          .select("o_orderkey", "start_dt", "raw", amount.alias("amount"), unit.alias("unit")))
    return df.select("o_orderkey", "start_dt", "raw",
                     add_days(F.col("start_dt"), F.coalesce(n, F.lit(0.0))).alias("end_dt"))


def _unit_days(u):
    expr = None
    for name, days in L.DURATION_UNIT_DAYS.items():
        expr = F.when(u == name, F.lit(float(days))) if expr is None else expr.when(u == name, F.lit(float(days)))
    return expr


INSTR_VERBS = ["Take", "", "Inject", "apply", "Give", ""]
INSTR_UNITS = ["mg", "tablet(s)", "units", "mL", "µg", "lozenges", "litres", "applications", "puffs",
               "MCG", "sachet", "drops"]
INSTR_FREQ = ["3 times a day", "OM", "at bedtime", "every 4 hours", "BD", "when required",
              "once daily", "every other day", "before meals", "(morning) ON", "", "twice a day"]
INSTR_DUR = ["for 5 days", "for up to 2 weeks", "", "once for 1 dose", "For 3 days", ""]
INSTR_SPECIAL = ["Apply to affected area", "  (Paracetamol) 1,000 mg OM  ", "", None,
                 "Take 2 tablet(s) 3 times a day for 5 days", "10 units at bedtime",
                 "2 lozenges every 4 hours", "1 applications BD", ". mg prn"]


def instruction_text(li) -> Column:
    q = F.col("l_quantity").cast("int").cast("string")
    built = F.concat_ws(" ", pick(F.col("l_partkey"), INSTR_VERBS), q, pick(F.col("l_suppkey"), INSTR_UNITS),
                        pick(F.col("l_orderkey"), INSTR_FREQ), pick(F.col("l_linenumber") + F.col("l_partkey"), INSTR_DUR))
    return F.when(F.pmod(F.col("l_partkey"), F.lit(7)) == 0,
                  pick(F.col("l_orderkey"), INSTR_SPECIAL)).otherwise(built)


@register
def q_med_parse(spark, sf_dir):
    from .functions.text import split_first_space, with_parsed_instruction
    li = table(spark, sf_dir, "lineitem")
    df = with_parsed_instruction(li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                           instruction_text(li).alias("raw")), F.col("raw"), "p")
    dose, dose_units = split_first_space(F.col("p.dose"))
    dur, dur_units = split_first_space(F.col("p.duration"))
    return df.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "raw",
                     F.col("p.instruction").alias("instruction"), dose.alias("dose"), dose_units.alias("dose_units"),
                     F.col("p.frequency").alias("frequency"), dur.alias("duration"), dur_units.alias("duration_units"))


# ---- merge, joins, unions, cleaners ------------------------------------------------------------

def part_versions(spark, sf_dir) -> list[DataFrame]:
    """`part` as three staged versions with drifted columns and types (every row is in one
    version; keys divisible by 5 are also repeated in a fourth, identical-after-cast copy)."""
    p = table(spark, sf_dir, "part")
    k3 = F.pmod(F.col("p_partkey"), F.lit(3))
    v1 = p.filter(k3 == 0).select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    v2 = p.filter(k3 == 1).select("p_partkey", "p_name", "p_type", F.col("p_size").cast("bigint").alias("p_size"),
                                  F.col("p_retailprice").cast("decimal(12,2)").alias("p_retailprice"))
    v3 = p.filter(k3 == 2).select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("p_size"),
                                  "p_type", F.col("p_size").cast("string").alias("p_container"))
    v4 = p.filter((k3 == 0) & (F.pmod(F.col("p_partkey"), F.lit(5)) == 0)).select(
        "p_partkey", "p_name", "p_brand", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return [v1, v2, v3, v4]


@register
def q_merge_versions(spark, sf_dir):
    from .operators.schema import merge_staged
    vs = part_versions(spark, sf_dir)
    staged = {"staging_src.part": vs[0], "staging_src.v2.part": vs[1], "staging_src.v3.part": vs[2],
              "staging_src.v4.part": vs[3]}
    return merge_staged(staged)["part"]


def encounters_ctx(spark, sf_dir):
    from .plans.cleaners import Context
    return Context(encounters=encounter_input(spark, sf_dir).select("visit_id", "mrn_sha1", "encounter_type"))


def enc_lineitems(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("ENC_KEY"), "l_linenumber", "l_partkey", "l_quantity")


@register
def q_enc_inner(spark, sf_dir):
    from .plans.cleaners import join_encounters
    ctx = encounters_ctx(spark, sf_dir)
    return join_encounters(enc_lineitems(spark, sf_dir), ctx, "ENC_KEY", "edw", "inner")


@register
def q_enc_left(spark, sf_dir):
    from .plans.cleaners import join_encounters
    ctx = encounters_ctx(spark, sf_dir)
    return join_encounters(enc_lineitems(spark, sf_dir), ctx, "ENC_KEY", "dts", "left")


@register
def q_hot_join(spark, sf_dir):
    """Lines joined to suppliers on a key that is null for a third of them and the same supplier for another third."""
    from .operators.joins import spread_join
    li = table(spark, sf_dir, "lineitem")
    m = F.pmod("l_linenumber", F.lit(3))
    li = li.select("l_orderkey", "l_linenumber", F.when(m == 1, F.lit(1)).when(m == 2, F.col("l_suppkey")).alias("hot_supplier"))
    su = table(spark, sf_dir, "supplier", spread=False).select("s_suppkey", "s_name")
    return spread_join(li, su, "hot_supplier", "s_suppkey", "left", hot_share=0.01).drop("s_suppkey")


def raw_dts_discharge_medication(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    return li.select(
        F.col("l_orderkey").alias("discharge_summary_id"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("medication_start_dt"),
        F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 5 DAYS"), "yyyy-MM-dd").alias("medication_end_dt"),
        pick(k, ["PO", "IV", "SC", "NG", "IM", "PR"]).alias("discharge_route"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit(None)).otherwise(F.concat(F.lit("drug "), k.cast("string")))
         .alias("medication_name"),
        instruction_text(li).alias("medication_dosage_regimen"))


def raw_dts_medication(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.concat(F.lit("mrn_"), c.cast("string")).alias("mrn_sha1"),
        F.concat_ws("|", pick(k, TOKEN_TEXTS[:4]), pick(c, ["IP", "OP", "DS"])).alias("medication_type"),
        formatted_ts(F.col("o_orderdate"), k).alias("first_start_dt"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), "dd/MM/yyyy").alias("last_end_dc_dt"),
        pick(c, ["PO", "IV", "SC", "NG", "IM", None]).alias("route_of_administration"),
        F.when(F.pmod(k, F.lit(6)) == 0, F.lit(None)).otherwise(F.concat(F.lit("med "), c.cast("string"))).alias("med"),
        (F.pmod(k, F.lit(40)) * 5).cast("string").alias("max_dose"),
        pick(k, ["mg", "mcg", "units", "mL"]).alias("dosage_quantity_unit"),
        pick(c, ["OM", "BD", "TDS", "ON"]).alias("frequency"),
        F.pmod(k, F.lit(90)).cast("string").alias("total_med_days"),
        F.lit("days").alias("duration_units"))


def raw_edw_medication(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    return li.select(
        F.col("l_orderkey").alias("ENC_KEY"),
        formatted_ts(F.col("l_shipdate"), F.col("l_linenumber") * 3).alias("STARTTIME"),
        F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 2 DAYS") + F.expr("INTERVAL 5 HOURS"),
                      "yyyy-MM-dd HH:mm:ss").alias("ENDTIME"),
        pick(k, ["PO", "IV", "SC", "NG"]).alias("ROUTECODE"),
        F.when(F.pmod(k, F.lit(5)) == 0, F.lit(None)).otherwise(F.concat(F.lit("order "), k.cast("string")))
         .alias("ORDERTEXT"),
        instruction_text(li).alias("MEDICATION"),
        pick(F.col("l_suppkey"), INSTR_SPECIAL + ["2 puffs BD for 3 days"]).alias("DOSAGEREGIMEN"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None)).otherwise(pick(k, ["OD", "BD", "TDS"])).alias("FREQUENCY1CODE"))


def raw_edw_outpatient_medication(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    return li.select(
        F.col("l_orderkey").alias("ENC_KEY"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("CREATION_DATE_KEY"),
        F.concat(F.lit("drug "), k.cast("string")).alias("DRUG_NAME"),
        instruction_text(li).alias("ORDER_INSTRUCTION_DESC"),
        dose_text(k, F.col("l_linenumber")).alias("DRUG_STRENGTH_AMT"),
        pick(F.col("l_suppkey"), INSTR_FREQ).alias("ORDER_FREQUENCY_DESC"),
        duration_text(F.col("l_orderkey") + F.col("l_linenumber"), k).alias("ORDER_DURATION_DESC"))


def raw_dts_laboratory(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return ev.select(
        F.concat(F.lit("mrn_"), F.col("user_id").cast("string")).alias("mrn_sha1"),
        pick(k, ["NUH", "AH", "NTFGH"]).alias("src_institution"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("specimen_collected_dt"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm:ss").alias("report_dt"),
        F.col("event_type").alias("investigation_item"), F.col("value").alias("numeric_value"),
        pick(k, ["mmol/L", "g/L", "%"]).alias("numeric_value_uom"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.col("props")).alias("text_value"))


def raw_edw_laboratory(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    return li.select(
        F.col("l_orderkey").alias("ENC_KEY"), pick(k, ["Lab A", "Lab B", "Ward 3"]).alias("REQ_LOCATION"),
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit("2021-13-45")).otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
         .alias("COLLECTION_DATE_SID"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("RESULT_TEST_DATE"),
        pick(F.col("l_suppkey"), ["HbA1c", "LDL", "Troponin", "Creatinine"]).alias("SHORTTEXT"),
        F.col("l_extendedprice").alias("TEST_RESULTS"), pick(k, ["%", "mmol/L", "ng/L", "umol/L"]).alias("UNITS"))


def _clean(spark, sf_dir, source, raw):
    from .plans.cleaners import CLEANERS, clean
    return clean(raw, CLEANERS[source], encounters_ctx(spark, sf_dir))


MEDICATION_SOURCES = {
    "ehr.dts_discharge_medication": raw_dts_discharge_medication,
    "ehr.dts_medication": raw_dts_medication,
    "ehr.edw_medication": raw_edw_medication,
    "ehr.edw_outpatient_medication": raw_edw_outpatient_medication,
}
LAB_SOURCES = {"ehr.dts_laboratory": raw_dts_laboratory, "ehr.edw_laboratory": raw_edw_laboratory}


@register
def q_med_union(spark, sf_dir):
    from .operators.schema import union_versions
    return union_versions([_clean(spark, sf_dir, s, fn(spark, sf_dir)) for s, fn in MEDICATION_SOURCES.items()])


@register
def q_lab_union(spark, sf_dir):
    from .operators.schema import union_versions
    return union_versions([_clean(spark, sf_dir, s, fn(spark, sf_dir)) for s, fn in LAB_SOURCES.items()])


@register
def q_cis_clean(spark, sf_dir):
    return _clean(spark, sf_dir, "cis.cag", cis_raw(spark, sf_dir))


def raw_ohca(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(F.concat(F.lit("mrn_"), F.col("o_custkey").cast("string")).alias("mrn_sha1"),
                    F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date of arrival at ED"),
                    pick(k, ARRIVAL_TIMES).alias("Time of arrival at ED"),
                    formatted_ts(F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS"), F.col("o_custkey"))
                    .alias("Date of Discharge or Death"),
                    F.col("o_orderstatus").alias("Outcome"))


CARDIAC_LONG_HEADERS = [
    "Renal disease at the time of surgery (choice=Functioning transplant)",
    "Other cardiac procedures (choice=Subaortic stenosis resection)",
    "Atrial fibrillation correction surgery (choice=Left atrial maze)",
    "PreOperative.Status/Ejection fraction (choice=Moderate 31-50%)",
]


def raw_cardiacsurgery(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cols = [F.concat(F.lit("mrn_"), F.col("o_custkey").cast("string")).alias("mrn_sha1"),
            F.date_format("o_orderdate", "MM/dd/yyyy").alias("Date of Surgery"),
            F.date_format(F.col("o_orderdate") - F.expr("INTERVAL 1 DAYS"), "yyyy-MM-dd HH:mm:ss")
            .alias("Date and Time of Admission"),
            formatted_ts(F.col("o_orderdate"), k).alias("date_and_time_of_operation"),
            F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 9 DAYS"), "dd/MM/yyyy")
            .alias("date_and_time_of_discharge_or_death"),
            F.col("o_totalprice").alias("EuroSCORE II")]
    cols += [pick(k + i, ["Checked", "Unchecked"]).alias(h) for i, h in enumerate(CARDIAC_LONG_HEADERS)]
    return o.select(*cols)


def raw_coronaryphysiology(spark, sf_dir):
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    gone = F.pmod(k, F.lit(9)) == 0
    return cu.select(F.when(gone, F.lit(None)).otherwise(F.col("c_name")).alias("Name"),
                     F.when(gone, F.lit(None)).otherwise(id_text(k)).alias("NRIC"),
                     F.when(gone, F.lit(None)).otherwise(F.col("c_acctbal")).alias("FFR"),
                     F.when(gone, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("Vessel"))


def raw_diagnosis_codes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("Code"), F.col("p_name").alias("Description"),
                    F.col("p_type").alias("Category Name"))


def raw_iecg(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    P = "restingecgdata/"
    S = P + "interpretations/interpretation/statement"
    lst = (F.when(F.pmod(k, F.lit(5)) == 0, F.lit("not a list"))
           .when(F.pmod(k, F.lit(5)) == 1, F.lit(None))
           .otherwise(F.concat(F.lit("[{'leftstatement': 'Sinus rhythm', 'rightstatement': '"),
                               pick(k, ["Normal ECG", "Borderline", "Abnormal"]),
                               F.lit("'}, {'leftstatement': '"), F.col("event_type"),
                               F.lit("', 'rightstatement': 'Rate '}]"))))
    return ev.select(
        F.concat(F.lit("C:\\ecg\\"), F.col("user_id").cast("string"), F.lit("_"), k.cast("string"), F.lit(".xml")).alias("filename"),
        F.date_format("ts", "yyyy-MM-dd").alias(P + "dataacquisition/@date"),
        F.date_format("ts", "HH:mm:ss").alias(P + "dataacquisition/@time"),
        lst.alias(S),
        pick(k, ["Normal sinus rhythm", "", None, "Left axis deviation"]).alias(S + "/leftstatement"),
        pick(k * 3, ["Normal ECG", "Abnormal ECG", ""]).alias(S + "/rightstatement"),
        pick(k, ["0.05", "0.15", None]).alias(P + "reportinfo/reportbandwidth/highpassfiltersetting"),
        pick(k, ["150", "40", "100"]).alias(P + "reportinfo/reportbandwidth/lowpassfiltersetting"),
        pick(k, ["50", None, "60"]).alias(P + "dataacquisition/signalcharacteristics/notchfilterfreqs"),
        pick(k, ["true", "false"]).alias(P + "reportinfo/reportbandwidth/artifactfilterflag"),
        pick(k * 7, ["True", "False", None]).alias(P + "reportinfo/reportbandwidth/hysteresisfilterflag"),
        F.col("value").cast("string").alias(P + "interpretations/interpretation/globalmeasurements/heartrate/#text"),
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit("n/a")).otherwise((F.col("value") * 40).cast("int").cast("string"))
         .alias(P + "internalmeasurements/crossleadmeasurements/meanqtint"),
        (F.col("value") * 41).cast("int").cast("string").alias(P + "internalmeasurements/crossleadmeasurements/meanqtc"),
        F.lit("500").alias(P + "dataacquisition/signalcharacteristics/samplingrate"),
        F.lit("12").alias(P + "dataacquisition/signalcharacteristics/numberchannelsvalid"),
        F.concat(F.lit("mrn_"), F.col("user_id").cast("string")).alias(P + "patient/generalpatientdata/patientid"),
        F.lit(None).cast("string").alias(P + "patient/generalpatientdata/age/dateofbirth"),
        F.pmod(F.col("user_id"), F.lit(60)).cast("string").alias(P + "patient/generalpatientdata/age/years"),
        pick(k, ["cart 1", "cart 2"]).alias(P + "dataacquisition/machine/@detaildescription"),
        F.lit("800").alias(P + "internalmeasurements/groupmeasurements/groupmeasurement/meanrrint"),
        F.lit("48").alias(P + "interpretations/interpretation/globalmeasurements/qonset/#text"),
        F.lit("60").alias(P + "internalmeasurements/crossleadmeasurements/pfrontaxis"),
        F.lit("30").alias(P + "internalmeasurements/crossleadmeasurements/qrsfrontaxis"),
        F.lit("45").alias(P + "internalmeasurements/crossleadmeasurements/stfrontaxis"))


def raw_muse(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    R = "RestingECG/"
    return ev.select(
        F.concat(F.lit("MUSE_"), F.date_format("ts", "yyyyMM")).alias("Folder"),
        F.concat(k.cast("string"), F.lit(".xml")).alias("Filename"),
        F.date_format("ts", "MM-dd-yyyy").alias(R + "TestDemographics/AcquisitionDate"),
        F.when(F.pmod(k, F.lit(31)) == 0, F.lit("25:61:00")).otherwise(F.date_format("ts", "HH:mm:ss"))
         .alias(R + "TestDemographics/AcquisitionTime"),
        F.concat(F.lit("mrn_"), F.col("user_id").cast("string")).alias(R + "PatientDemographics/PatientID"),
        F.pmod(F.col("user_id"), F.lit(70)).cast("string").alias(R + "PatientDemographics/PatientAge"),
        pick(k, ["Ward 1", "ED"]).alias(R + "TestDemographics/LocationName"),
        F.col("event_type").alias(R + "OriginalDiagnosis/DiagnosisStatement"),
        (F.col("value") * 10).cast("int").cast("string").alias(R + "RestingECGMeasurements/VentricularRate"),
        F.lit("400").alias(R + "RestingECGMeasurements/QTInterval"),
        F.lit("420").alias(R + "RestingECGMeasurements/QTCorrected"),
        F.lit("220").alias(R + "RestingECGMeasurements/QOnset"),
        F.lit("30").alias(R + "RestingECGMeasurements/RAxis"),
        F.lit("40").alias(R + "RestingECGMeasurements/TAxis"))


def raw_problem_list(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("mrn_"), F.col("o_custkey").cast("string")).alias("mrn_sha1"),
                    F.col("o_orderpriority").alias("Problem Name"), F.col("o_orderstatus").alias("Status"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("noted_dt"))


def raw_radiology(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return ev.select(F.concat(F.lit("mrn_"), F.col("user_id").cast("string")).alias("mrn_sha1"),
                     k.alias("id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("examination_dt"),
                     pick(k, ["XR", "CT", "MRI"]).alias("investigation_type"),
                     F.col("event_type").alias("investigation_name"), pick(k, ["chest pain", "sob"]).alias("reason_for_investign"),
                     pick(k, ["RPT", "ADD"]).alias("item_code"), F.col("props").alias("item_comment"),
                     pick(k, ["N", "A"]).alias("abnormal_flag_code"), (k * 7).alias("accession_num"),
                     F.lit("x").alias("extra_column"))


def raw_surgery(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(F.concat(F.lit("mrn_"), F.col("o_custkey").cast("string")).alias("mrn_sha1"), k.alias("id"),
                    pick(k, ["NUH", "AH"]).alias("src_institution"), F.pmod(k, F.lit(40)).alias("primary_operator_id"),
                    pick(k, ["CABG", "AVR", "MVR"]).alias("ot_procedure_name_code"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_dt"),
                    F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAYS"), "yyyy-MM-dd").alias("reported_dt"),
                    F.col("o_orderstatus").alias("doc_status"))


def raw_vitals(spark, sf_dir):
    from .plans.cleaners import VITALS_COLUMNS
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    cols = [F.concat(F.lit("mrn_"), F.col("user_id").cast("string")).alias("mrn_sha1"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("recorded_dt")]
    for i, c in enumerate(VITALS_COLUMNS[2:]):
        cols.append(F.when(F.pmod(k + i, F.lit(7)) == 0, F.lit('""""')).when(F.pmod(k + i, F.lit(7)) == 1, F.lit(""))
                    .otherwise(F.concat(F.lit(c[:3]), F.pmod(k, F.lit(97)).cast("string"))).alias(c))
    return ev.select(*cols)


def preprocessed(raw: DataFrame, table_name: str) -> DataFrame:
    """Preprocess stage: drop identifying columns of the table, redact ids in every string column."""
    from .operators.deid import drop_phi, redact_strings
    return redact_strings(drop_phi(raw, table_name))


def _cis_raw_for(table_name):
    def build(spark, sf_dir):
        df = cis_raw(spark, sf_dir)
        if table_name == "cis.caglesion":
            df = df.withColumn("lesion", pick(F.col("Contrast Volume").cast("bigint"), lesion_codes()))
        if table_name == "cis.echo":
            df = df.withColumn("finaldxcollated", pick(F.col("Contrast Volume").cast("bigint"), VALVE_STATEMENTS))
        return df
    return build


RAW_SOURCES = {
    "ccd.ohca": raw_ohca, "ccd.cardiacsurgery": raw_cardiacsurgery,
    "ccd.coronaryphysiology": raw_coronaryphysiology,
    **{f"cis.{t}": _cis_raw_for(f"cis.{t}") for t in ["cag", "caglesion", "echo", "nuclear", "pacemaker", "pci",
                                                       "pcidevicesequence", "pcidevicesequencetimings",
                                                       "pcilesionsequence", "procedure"]},
    "concept.diagnosis_codes": raw_diagnosis_codes, "ecg.iecg": raw_iecg, "ecg.muse": raw_muse,
    **MEDICATION_SOURCES, **LAB_SOURCES,
    "ehr.problem_list": raw_problem_list, "ehr.patient": patient_input, "ehr.encounter": encounter_input,
    "ehr.radiology": raw_radiology, "ehr.surgery": raw_surgery, "ehr.vitals": raw_vitals,
}


def _register_clean(source):
    def q(spark, sf_dir):
        return _clean(spark, sf_dir, source, preprocessed(RAW_SOURCES[source](spark, sf_dir), source))
    q.__name__ = "q_clean_" + source.replace(".", "_")
    return register(q)


for _src in RAW_SOURCES:
    _register_clean(_src)


# ---- schema inference and names ---------------------------------------------------------------

SUPPLIED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                   "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
UNMAPPED_STEM = "mystery_file"


_COLUMNS: dict[str, dict[str, list[str]]] = {}


def canonical_columns(spark, sf_dir) -> dict[str, list[str]]:
    """Reference schemas: the column lists of the supplied tables (parquet footers, read once a folder)."""
    if sf_dir not in _COLUMNS:
        _COLUMNS[sf_dir] = {t: table(spark, sf_dir, t, spread=False).columns for t in SUPPLIED_TABLES}
    return _COLUMNS[sf_dir]


def canon_df(spark, sf_dir) -> DataFrame:
    cols = canonical_columns(spark, sf_dir)
    rows = [(f"src.{t}", ti, i, c) for ti, (t, cs) in enumerate(cols.items()) for i, c in enumerate(cs)]
    return spark.createDataFrame(rows, "table string, table_pos int, pos int, column string")


def alias_df(spark) -> DataFrame:
    rows = [(f"{t}{suffix}", f"src.{t}") for t in SUPPLIED_TABLES for suffix in ("_export", "_v2")]
    return spark.createDataFrame(rows, "stem string, table string")


def raw_headers(spark, sf_dir) -> DataFrame:
    """One raw file per order: the header of one supplied table, perturbed per column
    (dropped, suffixed, upper-cased, '_' -> ' ', or kept) plus one extra column."""
    cols = canonical_columns(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    n = len(SUPPLIED_TABLES)
    tidx = F.pmod(k, F.lit(n))
    arrays = F.array(*[F.array(*[F.lit(x) for x in cols[t]]) for t in SUPPLIED_TABLES])
    names = F.array(*[F.lit(t) for t in SUPPLIED_TABLES])
    stem = F.when(F.pmod(k, F.lit(29)) == 0, F.lit(UNMAPPED_STEM)).otherwise(
        F.concat(F.element_at(names, (tidx + 1).cast("int")),
                 F.when(F.pmod(c, F.lit(2)) == 0, F.lit("_export")).otherwise(F.lit("_v2"))))
    base = o.select(F.concat(F.lit("file_"), k.cast("string")).alias("file"), k.alias("file_rank"), c.alias("ck"),
                    stem.alias("stem"), F.element_at(arrays, (tidx + 1).cast("int")).alias("cols"))
    ex = base.select("file", "file_rank", "ck", "stem", F.posexplode("cols").alias("pos", "col"))
    m = F.pmod(F.col("ck") + F.col("pos"), F.lit(6))
    name = (F.when(m == 0, F.lit(None)).when(m == 1, F.upper("col")).when(m == 2, F.concat("col", F.lit("s")))
            .when(m == 3, F.translate("col", "_", " ")).otherwise(F.col("col")))
    hdr = ex.select("file", "file_rank", "stem", "pos", name.alias("name")).filter(F.col("name").isNotNull())
    extra = base.select("file", "file_rank", "stem", F.lit(99).alias("pos"),
                        F.concat(F.lit("extra_"), F.pmod(F.col("ck"), F.lit(3)).cast("string")).alias("name"))
    return hdr.unionByName(extra)


@register
def q_schema_match(spark, sf_dir):
    from .operators.schema import match_scores
    return match_scores(raw_headers(spark, sf_dir), canon_df(spark, sf_dir), 0.8, "levenshtein")


@register
def q_schema_match_ratcliff(spark, sf_dir):
    from .operators.schema import match_scores
    return match_scores(raw_headers(spark, sf_dir), canon_df(spark, sf_dir), 0.9, "ratcliff")


@register
def q_table_infer(spark, sf_dir):
    from .operators.schema import infer_tables
    canon = canon_df(spark, sf_dir)
    order = canon.select("table", "table_pos").distinct()
    return infer_tables(raw_headers(spark, sf_dir), canon, order, 0.6, "levenshtein")


@register
def q_table_infer_ratcliff(spark, sf_dir):
    """Table inference as ingest does it: Ratcliff/Obershelp at 0.9."""
    from .operators.schema import infer_tables
    canon = canon_df(spark, sf_dir)
    order = canon.select("table", "table_pos").distinct()
    return infer_tables(raw_headers(spark, sf_dir), canon, order, 0.9, "ratcliff")


@register
def q_canonical_schema(spark, sf_dir):
    from .operators.schema import canonical_schema
    return canonical_schema(raw_headers(spark, sf_dir), alias_df(spark), key="stem")


@register
def q_unmapped(spark, sf_dir):
    from .operators.schema import unmapped_files
    files = raw_headers(spark, sf_dir).select("file", "stem").distinct()
    return unmapped_files(files, alias_df(spark), key="stem")


@register
def q_pad_schema(spark, sf_dir):
    from .operators.schema import best_renames, pad_to_schema
    o = table(spark, sf_dir, "orders")
    drifted = o.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("o_totalprices"),
                       F.col("o_orderdate").alias("o_orderdat"), F.lit("x").alias("extra_note"))
    canonical = o.columns
    rename = best_renames(drifted.columns, canonical, spark, 0.9)
    return pad_to_schema(drifted, canonical, rename)


def messy_names(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    m = F.pmod(k, F.lit(9))
    name = (F.when(m == 0, F.upper(F.concat(F.col("p_name"), F.lit(". ")))) 
            .when(m == 1, F.concat(F.col("p_type"), F.lit(" #"), F.col("p_size").cast("string")))
            .when(m == 2, F.concat(F.lit(" Right "), F.col("p_name")))
            .when(m == 3, F.concat(F.lit("camelCase"), F.translate("p_brand", "#", "")))
            .when(m == 4, F.concat(F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(" "), F.col("p_name")))
            .when(m == 5, F.lit("right"))
            .when(m == 6, F.lit("###"))
            .when(m == 7, F.concat(F.lit("Procedure_Date/"), F.col("p_type")))
            .otherwise(F.concat(F.lit("Study  Num."), F.pmod(k, F.lit(4)).cast("string"))))
    return p.select(F.col("p_brand").alias("file"), k.alias("pos"), name.alias("name"))


@register
def q_sanitize_names(spark, sf_dir):
    from .operators.schema import clean_header_rows
    return clean_header_rows(messy_names(spark, sf_dir))


@register
def q_shorten_names(spark, sf_dir):
    from .operators.schema import clean_header_rows
    from .plans.cleaners import CARDIAC_SURGERY_ABBREVIATIONS
    hdr = messy_names(spark, sf_dir).withColumn("name", F.concat(F.lit("Renal disease at the time of surgery "),
                                                                 F.col("name")))
    return clean_header_rows(hdr, CARDIAC_SURGERY_ABBREVIATIONS)


@register
def q_split_name(spark, sf_dir):
    from .functions.names import sanitize_table_name, split_dataset
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.translate(F.lower("p_brand"), "#", ""), F.lit("."), F.col("p_type"),
                   F.when(F.pmod(F.col("p_partkey"), F.lit(2)) == 0, F.lit(".csv")).otherwise(F.lit("")))
    df = p.select("p_partkey", raw.alias("raw"))
    ds, tb = split_dataset(F.col("raw"))
    return df.select("p_partkey", "raw", ds.alias("dataset"), tb.alias("tablename"),
                     sanitize_table_name(F.col("raw")).alias("sanitized"))


# ---- sources, sinks, ledgers, catalog -----------------------------------------------------------

@register
def q_manifest(spark, sf_dir):
    from .sources.files import manifest
    return manifest(spark, sf_dir, ("parquet",)).select("filename", "stem", "ext", "length")


@register
def q_checksum(spark, sf_dir):
    from .sources.files import manifest
    return manifest(spark, sf_dir, ("parquet",), checksum_mode="content").select("filename", "length", "checksum")


@register
def q_content_digest(spark, sf_dir):
    """The digest of an export of all orders, put together from the blocks its file is read in."""
    from .session import scratch_path
    from .sources.digests import content_digests
    o = table(spark, sf_dir, "orders", spread=False)
    path = scratch_path(spark, "digest")
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.coalesce("o_orderpriority", F.lit("")))
    o.orderBy("o_orderkey").select(line.alias("line")).coalesce(1).write.text(path)
    return content_digests(spark, path).select("lines", "length", "checksum")


@register
def q_row_counts(spark, sf_dir):
    from .sources.files import row_counts
    return row_counts({t: table(spark, sf_dir, t) for t in SUPPLIED_TABLES})


FINGERPRINT_COLS = ["o_orderkey", "o_orderstatus", "cents", "day"]


def customer_files(o: DataFrame) -> DataFrame:
    """Orders as per-customer 'export files' (name + content fingerprint)."""
    from .sources.ledger import fingerprint
    rows = o.select(F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"), F.lit(".csv")).alias("filename"),
                    "o_orderkey", "o_orderstatus",
                    F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return fingerprint(rows, ["filename"], FINGERPRINT_COLS)


@register
def q_ledger_anti(spark, sf_dir):
    from .sources.ledger import pending
    o = table(spark, sf_dir, "orders")
    current = customer_files(o)
    logged = customer_files(o.filter(F.col("o_orderstatus") != "P"))
    return pending(current, logged)


@register
def q_ledger_purge(spark, sf_dir):
    from .sources.ledger import purge
    led = customer_files(table(spark, sf_dir, "orders"))
    led = led.withColumn("tablename", pick(F.regexp_extract("filename", r"(\d+)", 1).cast("bigint"),
                                           ["cis.cag", "ehr.patient", "ecg.muse", "cis.echo"]))
    return purge(led, "cis")


@register
def q_data_dictionary(spark, sf_dir):
    from .sources.catalog import data_dictionary
    tabs = {f"main.{t}": table(spark, sf_dir, t) for t in SUPPLIED_TABLES}
    tabs["staging_main.orders"] = table(spark, sf_dir, "orders")
    return data_dictionary(spark, tabs)


SCRIPT = """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
       max(l_shipdate) AS last_ship
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus <> 'P'
GROUP BY l_returnflag, l_linestatus
"""


@register
def q_sql_script(spark, sf_dir):
    from .sources.catalog import run_script
    return run_script(spark, SCRIPT, {"lineitem": table(spark, sf_dir, "lineitem"), "orders": table(spark, sf_dir, "orders")})


@register
def q_script_folder(spark, sf_dir):
    """Two post-processing scripts from shared storage, with ';' in a string and in comments; the second uses the view of the first."""
    from .session import scratch_path
    from .sources.catalog import run_script_folder
    from .sources.versions import write_text
    folder = scratch_path(spark, "scripts")
    write_text(spark, f"{folder}/10_view.sql", "-- a view; kept for the next script\nCREATE OR REPLACE TEMP VIEW harmonia_by_status AS\n"
               "SELECT l_returnflag || ';' || l_linestatus AS status, l_quantity FROM lineitem; /* nothing; after it */")
    write_text(spark, f"{folder}/20_sum.sql", "SELECT status, count(*) AS n_lines, sum(l_quantity) AS sum_qty FROM harmonia_by_status GROUP BY status;")
    return run_script_folder(spark, folder, {"lineitem": table(spark, sf_dir, "lineitem")})["20_sum.sql"]


@register
def q_csv_round_trip(spark, sf_dir):
    from .session import scratch_path
    from .sources.files import read_raw
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "csv")
    o.write.option("header", True).csv(path)
    back = read_raw(spark, path, "csv")
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in o.schema.fields])


@register
def q_csv_records(spark, sf_dir):
    """Orders written as exports with quotes and line breaks inside values, and read back block by block."""
    from .session import scratch_path
    from .sources.records import read_csv
    o = table(spark, sf_dir, "orders")
    note = F.concat(F.col("o_orderstatus"), F.lit('\n"'), F.col("o_custkey").cast("string"), F.lit('",\n'), F.col("o_orderkey").cast("string"))
    path = scratch_path(spark, "csv-records")
    (o.select(F.col("o_orderkey").alias("order_key"), note.alias("note"), F.col("o_custkey").alias("customer"))
     .write.option("header", True).option("escape", '"').csv(path))
    return read_csv(spark, [path])["order_key", "note", "customer"]


@register
def q_json_round_trip(spark, sf_dir):
    from .session import scratch_path
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "json")
    o.write.json(path)
    return spark.read.schema(o.schema).json(path)


@register
def q_stage_append(spark, sf_dir):
    """Two sources staged into one table; re-running one source replaces its part, so a re-run never duplicates rows."""
    from .plans import stages as S
    from .session import scratch_path
    from .sources.versions import CommitLog
    o = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "stage")
    a, b = o.filter(F.col("o_orderstatus") == "F"), o.filter(F.col("o_orderstatus") != "F")
    S.put_part(spark, root, S.STAGED, "orders", "a", b, "first")
    S.put_part(spark, root, S.STAGED, "orders", "b", b, "first")
    S.put_part(spark, root, S.STAGED, "orders", "a", a, "second")   # source a again, with other rows
    parts = CommitLog(spark, root).entries(S.STAGED).collect()      # one entry a source
    return reduce(lambda x, y: x.unionByName(y),
                  [spark.read.parquet(f"{root}/{p['path']}").withColumn("source", F.lit(p["source"])) for p in parts])


def merged_after(spark, runs: list[dict[str, DataFrame]], name: str, with_support: bool = False) -> DataFrame:
    """The final table after several runs, each given as the rows of every source that exists then."""
    from .plans import stages as S
    from .session import scratch_path
    from .sources.versions import CommitLog
    root = scratch_path(spark, name)
    commits = CommitLog(spark, root)
    for n, sources in enumerate(runs):
        for source, rows in sources.items():
            S.put_part(spark, root, S.CLEANED, "main.t", source, rows, f"run {n}")
        gone = [(S.CLEANED, r["source"]) for r in commits.entries(S.CLEANED).collect() if r["source"] not in sources]
        if gone:
            commits.commit(spark.createDataFrame([], S.CHANGED), spark.createDataFrame(gone, "stage string, source string"))
        S.merge_stage(spark, root)
    return S.read_final(spark, root, "main.t", with_support)


@register
def q_final_overwrite(spark, sf_dir):
    """A final table whose only source is replaced by another export."""
    o = table(spark, sf_dir, "orders")
    return merged_after(spark, [{"a": o.filter(F.col("o_orderstatus") == "P")}, {"a": o}], "final")


@register
def q_stage_rerun(spark, sf_dir):
    """Three overlapping sources merged; then one shrinks, one vanishes and one comes.  The final rows, brought up to date from the
    change alone, carry in how many of the present sources each occurs."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    first = {"a": o.filter(key % 3 != 0), "b": o.filter(key % 3 != 1), "c": o.filter(F.col("o_orderstatus") != "P")}
    second = {"a": o.filter((key % 3 != 0) & (F.col("o_orderstatus") == "F")), "c": first["c"], "d": o.filter(key % 5 == 0)}
    return merged_after(spark, [first, second], "rerun", with_support=True).withColumnRenamed("_support", "n_sources")


@register
def q_strip_prefix(spark, sf_dir):
    from .plans.cleaners import strip_prefix_map
    ev = table(spark, sf_dir, "events")
    pre = "restingecgdata/dataacquisition/signalcharacteristics/"
    df = ev.select("event_id", F.col("value").alias(pre + "samplingrate"), F.col("user_id").alias(pre + "channels"),
                   F.col("event_type").alias("event_type"))
    m = strip_prefix_map(df.columns, pre)
    return df.select(*[F.col(f"`{c}`").alias(m.get(c, c)) for c in df.columns])


# ---- quality ------------------------------------------------------------------------------------

@register
def q_code_violations(spark, sf_dir):
    from .operators.quality import code_violations
    o = table(spark, sf_dir, "orders")
    enc = encounter_input(spark, sf_dir).join(
        o.select(F.concat(F.when(F.pmod("o_orderkey", F.lit(2)) == 1, F.lit("edw_")).otherwise(F.lit("hosp_")),
                          F.col("o_orderkey").cast("string")).alias("visit_id"),
                 code_text(F.col("o_orderkey"), F.col("o_custkey")).alias("raw_code")), "visit_id", "left")
    enc = enc.withColumn("primary_diagnosis", F.coalesce("raw_code", "primary_diagnosis"))
    return code_violations(enc)


@register
def q_date_violations(spark, sf_dir):
    from .functions.dates import parse_mixed
    from .operators.quality import date_violations
    df = cis_raw(spark, sf_dir).withColumn(
        "Procedure Date", F.when(F.col("Procedure Date") == L.CIS_DATE_SENTINEL, F.lit(None)).otherwise(
            F.when(F.pmod(F.length("IDRef"), F.lit(3)) == 0, F.lit("31/31/2020")).otherwise(F.col("Procedure Date"))))
    return date_violations(df, "Study Num", "Procedure Date", parse_mixed(F.col("`Procedure Date`")))


@register
def q_row_parity(spark, sf_dir):
    from .operators.quality import row_parity
    from .session import scratch_path
    from .sources.files import row_counts
    src = {t: table(spark, sf_dir, t) for t in ["orders", "customer", "part"]}
    base = scratch_path(spark, "parity")
    for t, df in src.items():
        df.write.mode("overwrite").parquet(f"{base}/{t}")
    loaded = {t: spark.read.parquet(f"{base}/{t}") for t in src}
    return row_parity(row_counts(src), row_counts(loaded))


EXPORT_NOW = "2025-06-30 00:00:00"


@register
def q_export_date(spark, sf_dir):
    from .operators.quality import export_date
    o = table(spark, sf_dir, "orders").withColumn("note", F.date_format("o_orderdate", "MM/dd/yyyy"))
    ev = table(spark, sf_dir, "events")
    return export_date(o, EXPORT_NOW).select(F.lit("orders").alias("table"), "export_date").unionByName(
        export_date(ev, EXPORT_NOW).select(F.lit("events").alias("table"), "export_date"))


@register
def q_fingerprint(spark, sf_dir):
    from .sources.ledger import fingerprint
    o = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("table"), "o_orderkey", "o_orderstatus",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return fingerprint(o, ["table"], FINGERPRINT_COLS)


@register
def q_stream_ingest(spark, sf_dir):
    """Structured Streaming ingest of the orders export (as a folder of files) with
    availableNow: PHI drop + id redaction per micro-batch, idempotent batch folders."""
    from .session import scratch_path
    from .streaming.ingest import ingest_folder
    o = table(spark, sf_dir, "orders").withColumn("Comments", F.concat(F.lit("S"), F.lpad(
        F.col("o_custkey").cast("string"), 7, "0"), F.lit("A")))
    raw = scratch_path(spark, "stream-raw")
    o.repartition(4).write.parquet(raw)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    ingest_folder(spark, raw, o.schema, "cis.cag", out, ck, max_files_per_trigger=2)
    return spark.read.parquet(out).drop("query_id", "batch_id")


@register
def q_stream_commit(spark, sf_dir):
    """Two streams, each with its own checkpoint, into one staged table; one of them runs twice.  A drifted header is matched to the
    canonical one, an absent column padded, and every batch is a part of the commit log."""
    from .plans import stages as S
    from .session import scratch_path
    from .streaming.ingest import ingest_stream
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("o_orderstatuss"), "o_totalprice")
    root = scratch_path(spark, "stream-root")
    known = {"src.region": ["r_regionkey", "r_name"], "src.orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_clerk"]}
    for odd in (0, 1, 1):
        raw, ck = f"{root}/raw{odd}", f"{root}/checkpoint{odd}"
        o.where(F.pmod("o_orderkey", F.lit(2)) == odd).repartition(2).write.mode("ignore").parquet(raw)
        ingest_stream(spark, raw, o.schema, root, known, ck, threshold=0.8, max_files_per_trigger=1)
    return S.read_staged(spark, root, "src.orders")
