"""DuckDB SQL equivalents of ``queries.QUERIES`` (same input expressions, same output names).

Some statements are generated from the same vocabularies the library uses; the generation is
plain string building over the fixed lists in ``lookups``.
"""

from __future__ import annotations

from . import lookups as L
from . import queries as Q

ORACLE: dict[str, str] = {}


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def pick(expr: str, values: list) -> str:
    return f"([{', '.join(lit(v) for v in values)}])[(({expr}) % {len(values)}) + 1]"


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def values_table(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


# ---- derived tables -----------------------------------------------------------------------------

LESION_INPUT = f"""
SELECT l_suppkey AS subject_id, l_shipdate AS procedure_date, l_orderkey AS study_id,
       {pick('l_partkey + l_linenumber', Q.lesion_codes())} AS lesion, l_quantity AS stenosis
FROM lineitem"""


def _lesion_pivot() -> str:
    segs = ",\n  ".join(
        f"coalesce(max(CASE WHEN segment = {lit(s)} THEN stenosis END), 0) AS {ident(s)}"
        for s in L.LESION_SEGMENTS)
    lk = values_table([(c, s) for c, s, _ in L.lesion_lookup_rows()], ["code", "segment"])
    return f"""
WITH src AS ({LESION_INPUT}), lk AS (SELECT * FROM {lk})
SELECT max(subject_id) AS subject_id, max(procedure_date) AS procedure_date, study_id,
  {segs}
FROM src JOIN lk ON src.lesion = lk.code
GROUP BY study_id"""


ORACLE["q_lesion_pivot"] = _lesion_pivot()


def _valve_input() -> str:
    S, SEP = Q.VALVE_STATEMENTS, Q.VALVE_SEPARATORS
    text = (f"{pick('o_orderkey', S)} || {pick('o_custkey', SEP)} || "
            f"{pick('o_orderkey + o_custkey', S + [''])} || {pick('o_orderkey * 7', SEP)} || "
            f"{pick('o_custkey * 3 + o_orderkey', S + ['', ''])}")
    return f"""
SELECT o_custkey AS subject_id, o_orderkey AS study_id, o_orderdate AS procedure_date,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN upper({text}) ELSE {text} END
    AS finaldxcollated
FROM orders"""


def _contains_any(col: str, kws) -> str:
    return "(" + " OR ".join(f"contains({col}, {lit(k)})" for k in kws) + ")"


def _first_label(col: str, labels) -> str:
    return "CASE " + " ".join(f"WHEN {_contains_any(col, kws)} THEN {lit(lab)}" for lab, kws in labels) + " END"


def _valve_entries() -> str:
    groups = {g: labels for g, _, labels in L.valve_groups()}
    arr = r"regexp_split_to_array(translate(lower(coalesce(finaldxcollated, 'none')), '-_', '  '), '\. |¤|§')"
    anat = " UNION ALL ".join(
        f"SELECT study_id, pos, {lit(a)} AS anat, vt, les, sev FROM cls WHERE {_contains_any('s', kws)}"
        for a, kws in groups["anatomy"])
    return f"""
rep AS ({_valve_input()}),
st AS (SELECT study_id, unnest({arr}) AS s, generate_subscripts({arr}, 1) AS pos FROM rep),
cls AS (SELECT study_id, pos, s, {_first_label('s', groups['valve_type'])} AS vt,
          {_first_label('s', groups['lesion'])} AS les, {_first_label('s', groups['severity'])} AS sev
        FROM st),
an AS ({anat}),
ent AS (SELECT study_id, anat || coalesce('_' || vt, '') || '_' || les AS key, arg_max(sev, pos) AS value
        FROM an WHERE les IS NOT NULL AND sev IS NOT NULL GROUP BY ALL)"""


ORACLE["q_valve_map"] = f"""
WITH {_valve_entries()},
txt AS (SELECT study_id, string_agg(key || '=' || value, ';' ORDER BY key) AS t FROM ent GROUP BY study_id)
SELECT subject_id, rep.study_id, procedure_date, coalesce(t, '') AS valve_findings
FROM rep LEFT JOIN txt ON rep.study_id = txt.study_id"""


def _valve_wide() -> str:
    cols = ",\n  ".join(f"max(CASE WHEN key = {lit(k)} THEN value END) AS {ident(k)}"
                        for k in L.valve_key_space())
    outs = ", ".join(f"w.{ident(k)}" for k in L.valve_key_space())
    return f"""
WITH {_valve_entries()},
w AS (SELECT study_id, {cols} FROM ent GROUP BY study_id)
SELECT subject_id, rep.study_id, procedure_date, finaldxcollated, {outs}
FROM rep LEFT JOIN w ON rep.study_id = w.study_id"""


ORACLE["q_valve_wide"] = _valve_wide()


def encounter_input() -> str:
    db = "CASE WHEN o_orderkey % 11 = 0 THEN 'legacy' WHEN o_orderkey % 2 = 0 THEN 'dts' ELSE 'edw' END"
    edw = f"({db}) = 'edw'"
    prim = ("CASE WHEN o_custkey % 13 = 0 THEN NULL "
            f"WHEN {edw} AND o_orderkey % 3 = 0 THEN CAST(o_custkey % 60 AS VARCHAR) || '.0' "
            "ELSE CAST(o_custkey % 60 AS VARCHAR) END")
    sec = ("CASE WHEN o_orderkey % 7 = 0 THEN NULL "
           f"WHEN {edw} THEN CAST(o_orderkey % 55 AS VARCHAR) || '.0,' || CAST(o_custkey % 50 AS VARCHAR) || '.0' "
           "ELSE CAST(o_orderkey % 55 AS VARCHAR) || ',' || CAST(o_custkey % 50 AS VARCHAR) END")
    return f"""
SELECT CASE WHEN {edw} THEN 'edw_' ELSE 'hosp_' END || CAST(o_orderkey AS VARCHAR) AS visit_id,
  'mrn_' || CAST(o_custkey AS VARCHAR) AS mrn_sha1,
  {pick('o_orderkey', ['IP', 'OP', 'AE', 'DS', 'Inpatient visit', 'Emergency', 'ward'])} AS encounter_type,
  {db} AS db_source, {prim} AS primary_diagnosis, {sec} AS secondary_diagnosis,
  o_orderdate AS visit_date, o_orderpriority AS location, o_orderstatus AS sub_location,
  {pick('o_orderkey', Q.VISIT_OUTCOMES)} AS visit_outcome
FROM orders"""


def _dx_flags() -> str:
    comb = (r"CASE WHEN db_source = 'edw' THEN concat_ws(',', regexp_replace(primary_diagnosis, '\.0(,|$)', '\1', 'g'), "
            r"regexp_replace(secondary_diagnosis, '\.0(,|$)', '\1', 'g')) "
            "WHEN db_source = 'dts' THEN concat_ws(',', primary_diagnosis, secondary_diagnosis) ELSE '' END")
    flags = []
    for dx in L.diagnosis_categories():
        whens = " ".join(
            f"WHEN db_source = {lit(db)} THEN CAST(list_has_any(string_split(combined_diagnosis, ','), "
            f"[{', '.join(lit(c) for c in sets[dx])}]) AS INTEGER)"
            for db, sets in L.DIAGNOSIS_CODE_SETS.items() if dx in sets)
        flags.append(f"CASE {whens} ELSE 0 END AS {ident(dx)}")
    deaths = ", ".join(lit(x) for x in L.DEATH_OUTCOMES)
    return f"""
WITH e AS ({encounter_input()}),
c AS (SELECT *, {comb} AS combined_diagnosis FROM e)
SELECT visit_id, mrn_sha1 AS subject_id, visit_date, location, sub_location, combined_diagnosis,
  {', '.join(flags)}, CAST(coalesce(visit_outcome IN ({deaths}), false) AS INTEGER) AS death
FROM c"""


ORACLE["q_dx_flags"] = _dx_flags()
ORACLE["q_dx_flags_join"] = ORACLE["q_dx_flags"]


def patient_input() -> str:
    k = "c_custkey"
    cols = [
        f"'mrn_' || CAST({k} AS VARCHAR) AS mrn_sha1",
        f"'19' || lpad(CAST({k} % 70 + 20 AS VARCHAR), 2, '0') || '-0' || CAST({k} % 9 + 1 AS VARCHAR) "
        f"|| '-1' || CAST({k} % 10 AS VARCHAR) AS dob",
        f"{pick(k, ['F', 'M', 'U', '1', '2', 'X', None])} AS gender",
        f"CASE WHEN {k} % 9 = 0 THEN '2021-06-01' WHEN {k} % 9 = 1 THEN 'junk' END AS death_indicator",
        f"{pick(k + ' * 3', ['C', 'CA', 'CN', 'EU', 'I', 'IN', 'M', 'MY', 'N', 'O', 'S', 'SK', 'XX', 'ZZ'])} AS ethnicity_race",
        f"'2015-0' || CAST({k} % 9 + 1 AS VARCHAR) || '-01' AS first_followup_dt",
        f"'03/' || lpad(CAST({k} % 28 + 1 AS VARCHAR), 2, '0') || '/2022' AS last_followup_dt",
        f"{pick(k, ['dts', 'edw'])} AS db_source",
        "c_mktsegment AS last_encounter_location",
    ]
    for i, dx in enumerate(L.COMORBIDITIES):
        cols.append(f"CAST(({k} + {i}) % 2 AS VARCHAR) AS {dx}")
        cols.append(f"CASE WHEN ({k} + {i}) % 2 = 1 THEN '2020-' || lpad(CAST(({k} + {i}) % 12 + 1 AS VARCHAR), 2, '0') "
                    f"|| '-15' END AS {dx}_onset")
    return "SELECT " + ",\n  ".join(cols) + "\nFROM customer"


ORACLE["q_comorbidity"] = f"""
SELECT mrn_sha1 AS subject_id, {', '.join(c for dx in L.COMORBIDITIES for c in (dx, dx + '_onset'))}
FROM ({patient_input()})"""


# ---- column functions ---------------------------------------------------------------------------

def _when_contains_chain(col, rules):
    return "CASE " + " ".join(f"WHEN {_contains_any(col, needles)} THEN {lit(label)}"
                              for needles, label in rules) + " END"


ORACLE["q_med_type"] = f"""
SELECT o_orderkey, raw, {_when_contains_chain('raw', L.MEDICATION_CLASS_RULES)} AS medication_type
FROM (SELECT o_orderkey, {pick('o_orderkey + o_custkey', Q.MED_TYPE_TEXTS)} AS raw FROM orders)"""

ORACLE["q_unique_tokens"] = f"""
SELECT o_orderkey, raw, array_to_string(list_sort(list_distinct(string_split(raw, '|'))), '|') AS medication_type
FROM (SELECT o_orderkey, concat_ws('|', {pick('o_orderkey', Q.TOKEN_TEXTS)}, o_orderstatus,
        {pick('o_custkey', Q.TOKEN_TEXTS)}) AS raw FROM orders)"""


def duration_text(k, c):
    return (f"CASE WHEN {k} % 17 = 0 THEN NULL WHEN {k} % 13 = 0 THEN {pick(c, L.CYCLE_RANGES)} "
            f"WHEN {k} % 11 = 0 THEN CAST({k} % 14 AS VARCHAR) || 'days' "
            f"ELSE CAST({k} % 14 AS VARCHAR) || ' ' || {pick(c, Q.DURATION_UNITS)} END")


def split_first_space(x):
    return (f"split_part({x}, ' ', 1)",
            f"CASE WHEN strpos({x}, ' ') > 0 THEN substr({x}, strpos({x}, ' ') + 1) END")


_a, _u = split_first_space("raw")
ORACLE["q_split_unit"] = f"""
SELECT o_orderkey, raw, {_a} AS amount, {_u} AS unit
FROM (SELECT o_orderkey, {duration_text('o_orderkey', 'o_custkey')} AS raw FROM orders)"""


def dose_text(k, size):
    return f"CASE WHEN {k} % 3 = 0 THEN CAST({size} AS VARCHAR) || ' mg' ELSE {pick(k, Q.DOSE_TEXTS)} END"


def last_number(x, mode="full"):
    p = r"([\d.,]*\d)(\D*)$" if mode == "full" else r"(\d+)(\D*)$"
    return (rf"CASE WHEN regexp_matches({x}, '\d') THEN regexp_extract({x}, '{p}', 1) END",
            rf"CASE WHEN regexp_matches({x}, '\d') THEN regexp_extract({x}, '{p}', 2) END")


_d1, _u1 = last_number("raw", "full")
_d2, _u2 = last_number("raw", "last_run")
ORACLE["q_last_number"] = f"""
SELECT p_partkey, raw, {_d1} AS dose, {_u1} AS dose_units, {_d2} AS dose_last_run, {_u2} AS dose_units_last_run
FROM (SELECT p_partkey, {dose_text('p_partkey', 'p_size')} AS raw FROM part)"""


def numeric_code(x):
    d = f"TRY_CAST({x} AS DECIMAL(38,10))"
    return (f"CASE WHEN {x} IS NULL THEN '-9999' "
            f"WHEN {d} IS NOT NULL THEN CASE WHEN abs({d}) < 1 THEN '0' ELSE split_part(CAST({d} AS VARCHAR), '.', 1) END "
            rf"WHEN contains({x}, ',') THEN regexp_replace({x}, '\.0(,|$)', '\1', 'g') END")


def code_text(k, c):
    return f"CASE WHEN {k} % 3 = 0 THEN CAST({c} AS VARCHAR) || '.0' ELSE {pick(k, Q.CODE_TEXTS)} END"


ORACLE["q_code_clean"] = f"""
SELECT o_orderkey, raw, {numeric_code('raw')} AS code
FROM (SELECT o_orderkey, {code_text('o_orderkey', 'o_custkey')} AS raw FROM orders)"""

ID_RE = r"'^[a-zA-Z]{1,2}[0-9]{7}[a-zA-Z]?\n?\z'"


def redact(x):
    return f"CASE WHEN regexp_matches({x}, {ID_RE}) THEN '[REDACTED]' ELSE {x} END"


def id_text(k):
    d7 = f"lpad(CAST({k} AS VARCHAR), 7, '0')"
    return (f"CASE {k} % 8 WHEN 0 THEN 'S' || {d7} || 'D' WHEN 1 THEN 'ab' || {d7} "
            f"WHEN 2 THEN 'S' || lpad(CAST({k} AS VARCHAR), 6, '0') || 'D' WHEN 3 THEN 'xS' || {d7} || 'D' "
            f"WHEN 4 THEN 'id S' || {d7} || 'D' WHEN 5 THEN 'T' || lpad(CAST({k} AS VARCHAR), 8, '0') "
            f"WHEN 6 THEN 'G' || {d7} || 'X' || chr(10) ELSE 'abc' || {d7} END")


ORACLE["q_redact_id"] = f"""
SELECT c_custkey, {redact('nric')} AS nric, {redact('c_name')} AS c_name,
  {redact('c_mktsegment')} AS c_mktsegment, c_acctbal
FROM (SELECT c_custkey, {id_text('c_custkey')} AS nric, c_name, c_mktsegment, c_acctbal FROM customer)"""


def pseudonym(x, length=None):
    s = L.TEST_SECRET
    return f"substr(sha1({x} || {lit(s['salt'])}), {s['start_idx'] + 1}, {length or s['length']})"


_STEM = r"split_part(string_split('D:\ecg\export\' || c_name || '.xml', '\')[-1], '.xml', 1)"
ORACLE["q_pseudonym"] = f"""
SELECT c_custkey,
  {pseudonym("CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END")} AS name_hash,
  {pseudonym(_STEM, 30)} AS study_id
FROM customer"""


def cis_raw():
    return f"""
SELECT 'mrn_' || CAST(o_custkey AS VARCHAR) AS IDRef, 'ST' || CAST(o_orderkey AS VARCHAR) AS "Study Num",
  CASE WHEN o_orderkey % 19 = 0 THEN '00/00/00' WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
       ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "Procedure Date",
  o_orderpriority AS Proc_HospitalID, {pick('o_orderkey', ['CAG', 'PCI', 'Echo', 'Nuclear'])} AS Procedure2,
  'rf' || CAST(o_orderkey AS VARCHAR) AS RF_IDRef, 'N' AS VIP, {pick('o_custkey', ['R1', 'R2', ''])} AS ResCode,
  'Patient S' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') || 'A seen' AS Comments,
  strftime(o_orderdate, '%d/%m/%Y') AS "Case Closed Date", '<html/>' AS HTML,
  {pick('o_orderkey', ['Nurse A', 'Nurse B'])} AS ScrubNurse1,
  'S' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') || 'Z' AS Radiographer,
  o_totalprice AS "Contrast Volume", o_orderstatus AS Outcome
FROM orders"""


ORACLE["q_drop_phi"] = f"""
SELECT {redact('IDRef')} AS IDRef, {redact('"Study Num"')} AS "Study Num",
  {redact('"Procedure Date"')} AS "Procedure Date", {redact('Proc_HospitalID')} AS Proc_HospitalID,
  {redact('Procedure2')} AS Procedure2, "Contrast Volume", {redact('Outcome')} AS Outcome
FROM ({cis_raw()})"""


def recode(x, mapping):
    return "CASE " + " ".join(f"WHEN {x} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + f" ELSE {x} END"


ORACLE["q_recode"] = f"""
SELECT mrn_sha1, {recode('gender', L.GENDER_RECODE)} AS gender,
  {recode('ethnicity_race', L.ETHNICITY_RECODE)} AS ethnicity_race, {recode('route', L.ROUTE_RECODE)} AS route
FROM ({patient_input()}) p
JOIN (SELECT c_custkey, {pick('c_custkey', ['PO', 'IV', 'SC', 'NG', 'IM', 'PR', None])} AS route FROM customer) cu
  ON p.mrn_sha1 = 'mrn_' || CAST(cu.c_custkey AS VARCHAR)"""

ORACLE["q_sentinel_null"] = f"""
SELECT event_id, {", ".join(f"CASE WHEN {c} IN ('', '\"\"\"\"') THEN NULL ELSE {c} END AS {c}"
                             for c in ["temperature", "temperature_uom", "o2_device"])}, value
FROM (SELECT event_id, {pick('event_id', ['37.1', '', '""""', '36.8', None])} AS temperature,
        {pick('event_id * 3', ['degC', '""""', ''])} AS temperature_uom,
        CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS o2_device, value FROM events)"""

ORACLE["q_coalesce"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  coalesce(CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'drug ' || CAST(l_partkey AS VARCHAR) END,
           'Take ' || CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || ' mg') AS medication_name,
  'Take ' || CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || ' mg' AS instruction,
  coalesce(CASE WHEN l_partkey % 2 = 0 THEN l_quantity END, CASE WHEN l_partkey % 5 = 0 THEN l_tax END,
           l_discount) AS dose
FROM lineitem"""

_DN_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
ORACLE["q_drop_all_null"] = f"""
SELECT * FROM (SELECT {", ".join(
    f"CASE WHEN o_orderkey % 10 = 0 OR (o_orderkey % 10 = 1 AND {lit(c != 'o_orderstatus')}) THEN NULL ELSE {c} END AS {c}"
    for c in _DN_COLS)} FROM orders)
WHERE NOT ({" AND ".join(f"{c} IS NULL" for c in _DN_COLS)})"""

ORACLE["q_dedup"] = "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders"


def spark_to_strptime(fmt: str) -> str:
    import re
    table = {"yyyy": "%Y", "MM": "%m", "M": "%m", "dd": "%d", "d": "%d", "HH": "%H", "H": "%H",
             "mm": "%M", "m": "%M", "ss": "%S", "s": "%S", "'T'": "T"}
    return re.sub(r"yyyy|MM|M|dd|d|HH|H|mm|m|ss|s|'T'", lambda m: table[m.group(0)], fmt)


def parse_mixed(x, dayfirst=False):
    """Formats written by hand from the spellings that exports use; blanks are normalised and zones cut first."""
    n = (f"regexp_replace(regexp_replace(trim({x}), '\\s+', ' ', 'g'), "
         r"'(:\d{1,2}(?:\.\d+)?) ?(?:Z|UTC|[+-]\d{2}:?\d{2})$', '\1')")
    times = ["", " %H:%M", " %H:%M:%S", "T%H:%M", "T%H:%M:%S", " %I:%M %p", " %I:%M:%S %p", " %H:%M:%S.%f", "T%H:%M:%S.%f"]

    def tries(guard, dates, after=times):
        formats = "[" + ", ".join(lit(d + t) for d in dates for t in after) + "]"
        return f"CASE WHEN regexp_matches({n}, {lit(guard)}) THEN try_strptime({n}, {formats}) END"

    order = ["%d{0}%m{0}", "%m{0}%d{0}"] if dayfirst else ["%m{0}%d{0}", "%d{0}%m{0}"]
    return "coalesce(" + ", ".join([
        tries(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}(?:\D|$)", [o.format(sep) + "%Y" for sep in "/-" for o in order]),
        tries(r"^\d{1,2}[/-]\d{1,2}[/-]\d{2}(?:\D|$)", [o.format(sep) + "%y" for sep in "/-" for o in order]),
        tries(r"^\d{4}[/-]\d{1,2}[/-]\d{1,2}(?:\D|$)", ["%Y-%m-%d", "%Y/%m/%d"]),
        tries(r"^\d{1,2}[ -][A-Za-z]{3}[ -]\d{4}(?:\D|$)", ["%d-%b-%Y", "%d %b %Y"]),
        tries(r"^[A-Za-z]{3,9} \d{1,2}, \d{4}(?:\D|$)", ["%B %d, %Y"]),
        tries(r"^\d{8}$", ["%Y%m%d"], [""]), tries(r"^\d{14}$", ["%Y%m%d%H%M%S"], [""])]) + ")"


def parse_exact(x, fmt, guard):
    return f"CASE WHEN regexp_matches({x}, {lit(guard)}) THEN try_strptime({x}, {lit(spark_to_strptime(fmt))}) END"


def formatted_ts(ts, k):
    return (f"CASE ({k}) % 20 WHEN 0 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime({ts}, '%m/%d/%Y') "
            f"WHEN 2 THEN strftime({ts}, '%-d/%-m/%Y %-H:%M') WHEN 3 THEN strftime({ts}, '%Y%m%d') "
            f"WHEN 4 THEN 'junk' WHEN 5 THEN strftime({ts}, '%d/%m/%Y') WHEN 6 THEN strftime({ts}, '%Y-%m-%d') "
            f"WHEN 7 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S.%f') WHEN 8 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') "
            f"WHEN 9 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S+08:00') WHEN 10 THEN strftime({ts}, '%d-%b-%Y') "
            f"WHEN 11 THEN strftime({ts}, '%-d %b %Y %H:%M') WHEN 12 THEN strftime({ts}, '%B %-d, %Y') "
            f"WHEN 13 THEN strftime({ts}, '%m/%d/%y') WHEN 14 THEN strftime({ts}, '%m/%d/%Y %I:%M %p') "
            f"WHEN 15 THEN strftime({ts}, '%Y/%m/%d') WHEN 16 THEN strftime({ts}, '%Y%m%d%H%M%S') "
            f"WHEN 17 THEN strftime({ts}, ' %-d/%-m/%Y  %-H:%M:%S') END")


_ISO_GUARD = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ORACLE["q_date_coerce"] = f"""
SELECT event_id, raw, {parse_mixed('raw')} AS parsed,
  {parse_exact('raw', 'yyyy-MM-dd HH:mm:ss', _ISO_GUARD)} AS parsed_exact
FROM (SELECT event_id, {formatted_ts('ts', 'event_id')} AS raw FROM events)"""

ORACLE["q_date_mixed"] = f"""
SELECT o_orderkey, raw, {parse_mixed('raw')} AS month_first, {parse_mixed('raw', True)} AS day_first
FROM (SELECT o_orderkey, {formatted_ts("o_orderdate + INTERVAL 7 HOUR", 'o_orderkey + o_custkey')} AS raw FROM orders)"""


def pad_seconds(t):
    return f"CASE WHEN length({t}) - length(replace({t}, ':', '')) = 2 THEN {t} ELSE {t} || ':00' END"


ORACLE["q_date_shapes"] = f"""
WITH raw AS (SELECT {formatted_ts("(o_orderdate + INTERVAL 7 HOUR)", "o_orderkey + o_custkey")} AS exported, o_orderpriority AS priority FROM orders),
long AS (SELECT 'exported' AS "column", exported AS value FROM raw UNION ALL SELECT 'priority', priority FROM raw),
read AS (SELECT "column", value, {parse_mixed('value')} IS NOT NULL AS read,
           trim(regexp_replace(regexp_replace(regexp_replace(value, '[0-9]', '9', 'g'), '[A-Za-z]', 'a', 'g'), '\\s+', ' ', 'g')) AS shape
         FROM long WHERE trim(value) <> '')
SELECT "column", shape, count(*) AS rows, count(*) FILTER (WHERE read) AS parsed, count(*) FILTER (WHERE NOT read) AS unparsed,
  coalesce(min(value) FILTER (WHERE NOT read), min(value)) AS example
FROM read GROUP BY "column", shape"""

ORACLE["q_arrival_dt"] = f"""
SELECT o_orderkey, arrival_time, {parse_mixed("(arrival_date || ' ' || arrival_time)", True)} AS arrival_dt,
  {parse_mixed('discharge', True)} AS date_of_discharge_or_death
FROM (SELECT o_orderkey, arrival_date, {pad_seconds('arrival_time')} AS arrival_time, discharge
      FROM (SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS arrival_date,
              {pick('o_orderkey', Q.ARRIVAL_TIMES)} AS arrival_time,
              {formatted_ts('o_orderdate', 'o_custkey')} AS discharge FROM orders))"""

ORACLE["q_ecg_time"] = f"""
SELECT event_id,
  {parse_exact("concat_ws(' ', d, t)", 'yyyy-MM-dd HH:mm:ss', _ISO_GUARD)} AS iecg_time,
  {parse_exact("concat_ws(' ', md, t)", 'MM-dd-yyyy HH:mm:ss', r'^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$')} AS muse_time
FROM (SELECT event_id, CASE WHEN event_id % 29 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d') END AS d,
        strftime(ts, '%H:%M:%S') AS t, strftime(ts, '%m-%d-%Y') AS md FROM events)"""

ORACLE["q_day_diff"] = """
SELECT l_orderkey, l_linenumber, l_partkey, start_dt, end_dt,
  CAST(floor(date_diff('microsecond', start_dt, end_dt) / 86400000000) AS BIGINT) AS duration
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS start_dt,
        l_shipdate + to_hours(l_linenumber * 7 - 20 + l_partkey % 50) AS end_dt FROM lineitem)"""


def unit_days(u):
    return "CASE " + " ".join(f"WHEN {u} = {lit(k)} THEN {float(v)}" for k, v in L.DURATION_UNIT_DAYS.items()) + " END"


_am, _un = split_first_space("raw")
ORACLE["q_end_date"] = f"""
SELECT o_orderkey, start_dt, raw,
  start_dt + to_microseconds(CAST(coalesce(
    (CASE WHEN amount IN ({", ".join(lit(c) for c in L.CYCLE_RANGES)}) THEN 1.0 ELSE TRY_CAST(amount AS DOUBLE) END)
    * {unit_days('unit')}, 0.0) * 86400000000 AS BIGINT)) AS end_dt
FROM (SELECT o_orderkey, start_dt, raw, {_am} AS amount, {_un} AS unit
      FROM (SELECT o_orderkey, o_orderdate AS start_dt, lower({duration_text('o_orderkey', 'o_custkey')}) AS raw
            FROM orders))"""


def strip_ws(x):
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def parse_instruction(x):
    """The normalised instruction text (stripped, parentheses unwrapped) as SQL."""
    return rf"regexp_replace({strip_ws(x)}, '\((.*?)\)', '\1', 'g')"


def instruction_fields(s):
    """(dose, frequency, duration) SQL over a normalised instruction column ``s``."""
    ci = "(?i)"
    dose = f"nullif(replace(regexp_extract({s}, {lit(ci + L.INSTRUCTION_DOSE)}, 2), ',', ''), '')"
    dose = (f"CASE WHEN {dose} IS NULL AND contains(lower({s}), {lit(L.TOPICAL_PHRASE)}) "
            f"THEN {lit(L.TOPICAL_DOSE)} ELSE {dose} END")
    freq_raw = f"regexp_extract({s}, {lit(ci + L.INSTRUCTION_FREQUENCY)}, 0)"
    dur_raw = f"replace(regexp_extract({s}, {lit(ci + L.INSTRUCTION_DURATION)}, 0), 'for ', '')"
    return dose, f"nullif({strip_ws(freq_raw)}, '')", f"nullif({strip_ws(dur_raw)}, '')"


def instruction_text():
    built = (f"concat_ws(' ', {pick('l_partkey', Q.INSTR_VERBS)}, CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR), "
             f"{pick('l_suppkey', Q.INSTR_UNITS)}, {pick('l_orderkey', Q.INSTR_FREQ)}, "
             f"{pick('l_linenumber + l_partkey', Q.INSTR_DUR)})")
    return f"CASE WHEN l_partkey % 7 = 0 THEN {pick('l_orderkey', Q.INSTR_SPECIAL)} ELSE {built} END"


def _med_parse():
    dose, freq, dur = instruction_fields("s")
    d1, d2 = split_first_space("dose")
    u1, u2 = split_first_space("duration")
    return f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, raw, s AS instruction, {d1} AS dose, {d2} AS dose_units,
  frequency, {u1} AS duration, {u2} AS duration_units
FROM (SELECT *, {dose} AS dose, {freq} AS frequency, {dur} AS duration
      FROM (SELECT *, {parse_instruction('raw')} AS s
            FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {instruction_text()} AS raw FROM lineitem)))"""


ORACLE["q_med_parse"] = _med_parse()


# ---- merge, joins, unions ------------------------------------------------------------------------

ORACLE["q_merge_versions"] = """
SELECT DISTINCT * FROM (
  SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, CAST(p_size AS DOUBLE) AS p_size,
         CAST(p_retailprice AS DOUBLE) AS p_retailprice, CAST(NULL AS VARCHAR) AS p_type, CAST(NULL AS VARCHAR) AS p_container
  FROM part WHERE p_partkey % 3 = 0
  UNION ALL
  SELECT p_partkey, p_name, NULL, CAST(p_size AS DOUBLE), CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE), p_type, NULL
  FROM part WHERE p_partkey % 3 = 1
  UNION ALL
  SELECT p_partkey, NULL, p_brand, CAST(p_size AS DOUBLE), NULL, p_type, CAST(p_size AS VARCHAR)
  FROM part WHERE p_partkey % 3 = 2
  UNION ALL
  SELECT p_partkey, p_name, p_brand, CAST(p_size AS DOUBLE), p_retailprice, NULL, NULL
  FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 5 = 0)"""


def _enc_join(prefix, how):
    return f"""
SELECT li.*, e.mrn_sha1, e.encounter_type
FROM (SELECT l_orderkey AS ENC_KEY, l_linenumber, l_partkey, l_quantity FROM lineitem) li
{how} JOIN (SELECT TRY_CAST(replace(visit_id, '{prefix}_', '') AS BIGINT) AS v, mrn_sha1, encounter_type
            FROM ({encounter_input()}) WHERE contains(visit_id, '{prefix}')) e
  ON li.ENC_KEY = e.v"""


ORACLE["q_enc_inner"] = _enc_join("edw", "INNER")
ORACLE["q_enc_left"] = _enc_join("hosp", "LEFT")


def _cis_clean(phi, preprocess=True):
    raw_cols = ["IDRef", "Study Num", "Procedure Date", "Proc_HospitalID", "Procedure2", "RF_IDRef", "VIP",
                "ResCode", "Comments", "Case Closed Date", "HTML", "ScrubNurse1", "Radiographer",
                "Contrast Volume", "Outcome"]
    kept = [c for c in raw_cols if c not in set(phi or [])]
    red = ", ".join(f"{redact(ident(c))} AS {ident(c)}" if preprocess and c != "Contrast Volume" else ident(c)
                    for c in kept)
    pd_expr = f"strftime({parse_mixed(ident('Procedure Date'))}, '%Y-%m-%d %H:%M:%S')"
    head = ["IDRef AS subject_id", f"{pseudonym(ident('Study Num'))} AS study_id",
            f"{pd_expr} AS procedure_date"]
    if "Proc_HospitalID" in kept:
        head.append("Proc_HospitalID AS hospital")
    rest_map = {"Procedure2": "procedure_name", "Comments": "comments", "Case Closed Date": "case_closed_date",
                "HTML": "html", "ScrubNurse1": "scrubnurse1", "Radiographer": "radiographer",
                "Contrast Volume": "contrast_volume", "Outcome": "outcome"}
    rest = [f"{ident(c)} AS {rest_map[c]}" for c in kept if c in rest_map]
    return f"""
SELECT {', '.join(head + rest)}
FROM (SELECT * REPLACE (CASE WHEN "Procedure Date" = '00/00/00' THEN NULL ELSE "Procedure Date" END AS "Procedure Date")
      FROM (SELECT DISTINCT {red} FROM ({cis_raw()})))"""


ORACLE["q_cis_clean"] = _cis_clean(None, preprocess=False)
for _t in ["cag", "nuclear", "pacemaker", "pci", "pcidevicesequence", "pcidevicesequencetimings",
           "pcilesionsequence", "procedure"]:
    ORACLE[f"q_clean_cis_{_t}"] = _cis_clean(L.PHI_COLUMNS.get(f"cis.{_t}"))


def _lab_union():
    return f"""
SELECT mrn_sha1 AS subject_id, src_institution AS location, specimen_collected_dt, report_dt, investigation_item,
  numeric_value, numeric_value_uom, text_value
FROM (SELECT DISTINCT 'mrn_' || CAST(user_id AS VARCHAR) AS mrn_sha1, {pick('event_id', ['NUH', 'AH', 'NTFGH'])} AS src_institution,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS specimen_collected_dt,
        strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS report_dt, event_type AS investigation_item,
        value AS numeric_value, {pick('event_id', ['mmol/L', 'g/L', '%'])} AS numeric_value_uom,
        CASE WHEN event_id % 4 = 0 THEN props END AS text_value FROM events)
UNION ALL
SELECT e.mrn_sha1, REQ_LOCATION,
  CAST(CASE WHEN regexp_matches(COLLECTION_DATE_SID, '^\\d{{8}}$') THEN try_strptime(COLLECTION_DATE_SID, '%Y%m%d') END AS VARCHAR),
  CAST(CASE WHEN regexp_matches(RESULT_TEST_DATE, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_strptime(RESULT_TEST_DATE, '%Y-%m-%d') END AS VARCHAR),
  SHORTTEXT, TEST_RESULTS, UNITS, NULL
FROM (SELECT DISTINCT l_orderkey AS ENC_KEY, {pick('l_partkey', ['Lab A', 'Lab B', 'Ward 3'])} AS REQ_LOCATION,
        CASE WHEN l_partkey % 17 = 0 THEN '2021-13-45' ELSE strftime(l_shipdate, '%Y%m%d') END AS COLLECTION_DATE_SID,
        strftime(l_shipdate, '%Y-%m-%d') AS RESULT_TEST_DATE,
        {pick('l_suppkey', ['HbA1c', 'LDL', 'Troponin', 'Creatinine'])} AS SHORTTEXT, l_extendedprice AS TEST_RESULTS,
        {pick('l_partkey', ['%', 'mmol/L', 'ng/L', 'umol/L'])} AS UNITS FROM lineitem) li
LEFT JOIN (SELECT TRY_CAST(replace(visit_id, 'edw_', '') AS BIGINT) AS v, mrn_sha1
           FROM ({encounter_input()}) WHERE contains(visit_id, 'edw')) e ON li.ENC_KEY = e.v"""


ORACLE["q_lab_union"] = _lab_union()


# ---- schema inference and names ---------------------------------------------------------------

SUPPLIED_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _headers_cte():
    rows = [(f"src.{t}", ti, i, c) for ti, (t, cs) in enumerate(SUPPLIED_COLUMNS.items()) for i, c in enumerate(cs)]
    names = "[" + ", ".join(lit(t) for t in SUPPLIED_COLUMNS) + "]"
    n = len(SUPPLIED_COLUMNS)
    return f"""
canon AS (SELECT * FROM {values_table(rows, ['"table"', 'table_pos', 'pos', '"column"'])}),
base AS (SELECT 'file_' || CAST(o_orderkey AS VARCHAR) AS file, o_orderkey AS file_rank, o_custkey AS ck,
           CASE WHEN o_orderkey % 29 = 0 THEN '{Q.UNMAPPED_STEM}' ELSE {names}[(o_orderkey % {n}) + 1]
             || CASE WHEN o_custkey % 2 = 0 THEN '_export' ELSE '_v2' END END AS stem,
           o_orderkey % {n} AS tidx FROM orders),
ex AS (SELECT b.file, b.file_rank, b.ck, b.stem, c.pos, c."column" AS col FROM base b JOIN canon c ON c.table_pos = b.tidx),
hdr AS (SELECT file, file_rank, stem, pos, CASE (ck + pos) % 6 WHEN 0 THEN NULL WHEN 1 THEN upper(col)
          WHEN 2 THEN col || 's' WHEN 3 THEN replace(col, '_', ' ') ELSE col END AS name FROM ex),
headers AS (SELECT * FROM hdr WHERE name IS NOT NULL
            UNION ALL SELECT file, file_rank, stem, 99, 'extra_' || CAST(ck % 3 AS VARCHAR) FROM base)"""


def lev_sim(a, b):
    return (f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 "
            f"ELSE 1.0 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) END")


def _ratcliff_pairs(t):
    """All pairs of a canonical column and a header name with a difflib ratio of at least t; header names are a closed set."""
    from difflib import SequenceMatcher
    columns = sorted({c for cs in SUPPLIED_COLUMNS.values() for c in cs})
    names = sorted({n for c in columns for n in (c, c.upper(), c + "s", c.replace("_", " "))} | {f"extra_{i}" for i in range(3)})
    near = [(c, n) for c in columns for n in names if SequenceMatcher(None, c, n).real_quick_ratio() >= t]
    return [(c, n) for c, n in near if SequenceMatcher(None, c, n).ratio() >= t]


def _scores_cte(t, method="levenshtein"):
    good = (f"""SELECT c."table", c."column", n.name FROM names n, (SELECT DISTINCT "table", "column" FROM canon) c
         WHERE {lev_sim('c."column"', 'n.name')} >= {t}""" if method == "levenshtein" else
            f"""SELECT DISTINCT c."table", c."column", p.name FROM canon c
         JOIN (SELECT * FROM {values_table(_ratcliff_pairs(t), ['"column"', 'name'])}) p USING ("column")""")
    return f"""
names AS (SELECT DISTINCT name FROM headers),
good AS ({good}),
m AS (SELECT DISTINCT h.file, g."table", g."column" FROM headers h JOIN good g ON h.name = g.name),
sizes AS (SELECT "table", count(DISTINCT "column") AS n_ref FROM canon GROUP BY 1),
scores AS (SELECT m.file, m."table", count(*) / any_value(n_ref) AS score FROM m JOIN sizes USING ("table")
           GROUP BY m.file, m."table")"""


ORACLE["q_schema_match"] = f"WITH {_headers_cte()}, {_scores_cte(0.8)} SELECT file, \"table\", score FROM scores"

ORACLE["q_schema_match_ratcliff"] = f"WITH {_headers_cte()}, {_scores_cte(0.9, 'ratcliff')} SELECT file, \"table\", score FROM scores"


def _infer(t, method):
    return f"""
WITH {_headers_cte()}, {_scores_cte(t, method)},
ord AS (SELECT DISTINCT "table", table_pos FROM canon),
best AS (SELECT s.*, row_number() OVER (PARTITION BY file ORDER BY score DESC, table_pos) AS rn
         FROM scores s JOIN ord USING ("table")),
files AS (SELECT DISTINCT file FROM headers)
SELECT f.file, CASE WHEN coalesce(score, 0.0) >= {t} THEN b."table" ELSE 'unknown' END AS "table",
  coalesce(score, 0.0) AS score
FROM files f LEFT JOIN (SELECT * FROM best WHERE rn = 1) b ON f.file = b.file"""


ORACLE["q_table_infer"] = _infer(0.6, "levenshtein")
ORACLE["q_table_infer_ratcliff"] = _infer(0.9, "ratcliff")   # what ingest uses

_ALIASES = ", ".join(lit(f"{t}{s}") for t in SUPPLIED_COLUMNS for s in ("_export", "_v2"))
_ALIAS_ROWS = [(f"{t}{s}", f"src.{t}") for t in SUPPLIED_COLUMNS for s in ("_export", "_v2")]

ORACLE["q_canonical_schema"] = f"""
WITH {_headers_cte()},
al AS (SELECT * FROM {values_table(_ALIAS_ROWS, ['stem', '"table"'])}),
j AS (SELECT a."table", h.name AS "column", h.file_rank, h.pos,
        row_number() OVER (PARTITION BY a."table", h.name ORDER BY h.file_rank, h.pos) AS rn
      FROM headers h JOIN al a ON h.stem = a.stem)
SELECT "table", row_number() OVER (PARTITION BY "table" ORDER BY file_rank, pos) - 1 AS pos, "column"
FROM j WHERE rn = 1"""

ORACLE["q_unmapped"] = f"""
WITH {_headers_cte()}
SELECT DISTINCT file, stem FROM headers WHERE stem NOT IN ({_ALIASES})"""

ORACLE["q_pad_schema"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority,
  'x' AS extra_note FROM orders"""


def messy_names():
    return rf"""
SELECT p_brand AS file, p_partkey AS pos, CASE p_partkey % 9
  WHEN 0 THEN upper(p_name || '. ') WHEN 1 THEN p_type || ' #' || CAST(p_size AS VARCHAR)
  WHEN 2 THEN ' Right ' || p_name WHEN 3 THEN 'camelCase' || replace(p_brand, '#', '')
  WHEN 4 THEN p_name || ' ' || p_type || ' ' || p_name WHEN 5 THEN 'right' WHEN 6 THEN '###'
  WHEN 7 THEN 'Procedure_Date/' || p_type ELSE 'Study  Num.' || CAST(p_partkey % 4 AS VARCHAR) END AS name
FROM part"""


def _core_name(x, hash_to_no):
    y = f"lower({strip_ws(x)})"
    if hash_to_no:
        y = f"replace({y}, '#', 'no')"
    y = f"regexp_replace(regexp_replace({y}, '[ .]+', '_', 'g'), '[^a-z0-9_]', '', 'g')"
    return f"regexp_replace({y}, '_$', '')"


def sql_name(x):
    core = _core_name(x, True)
    return f"CASE WHEN {core} = 'right' THEN 'right_' ELSE {core} END"


def _clean_names(src, abbreviations=None):
    abbreviations = abbreviations or {}
    tok0 = (rf"list_transform(list_filter(regexp_split_to_array(lower(regexp_replace(name, '([a-z])([A-Z])', '\1_\2', 'g')), "
            rf"'[_\\/.]'), lambda t: t <> ''), lambda t: regexp_replace(regexp_replace(lower({strip_ws('t')}), '[ .]+', '_', 'g'), "
            rf"'[^a-z0-9_]', '', 'g'))")
    if abbreviations:
        case = "CASE t " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in abbreviations.items()) + " ELSE t END"
        abbr = f"list_transform(tok1, lambda t: {case})"
        whole = "CASE s " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in abbreviations.items()) + " ELSE s END"
    else:
        abbr, whole = "tok1", "s"
    return f"""
WITH h AS ({src}),
h1 AS (SELECT *, max(length(name)) OVER (PARTITION BY file) >= 59 AS is_long, {tok0} AS tok0 FROM h),
h2 AS (SELECT *, list_filter(tok0, lambda t, i: i = 1 OR tok0[i - 1] <> t) AS tok1 FROM h1),
h3 AS (SELECT *, {abbr} AS tok2 FROM h2),
h4 AS (SELECT *, list_filter(tok2, lambda t, i: i = 1 OR tok2[i - 1] <> t) AS tok3 FROM h3),
h5 AS (SELECT *, array_to_string(list_filter(tok3, lambda t: t <> ''), '_') AS s FROM h4),
h6 AS (SELECT *, {whole} AS short FROM h5),
h7 AS (SELECT *, row_number() OVER (PARTITION BY file, short ORDER BY pos) AS rn FROM h6),
h8 AS (SELECT *, CASE WHEN rn = 1 THEN short WHEN rn = 2 THEN concat_ws('_', short, substr(md5(short), 1, 4))
          ELSE concat_ws('_', short, substr(md5(short), 1, 4), CAST(rn - 1 AS VARCHAR)) END AS ushort FROM h7),
h9 AS (SELECT *, {sql_name(f"CASE WHEN is_long THEN ushort ELSE {_core_name('name', False)} END")} AS c0 FROM h8),
h10 AS (SELECT file, pos, name, CASE WHEN c0 = '' THEN 'col_' || CAST(pos AS VARCHAR) ELSE c0 END AS clean_name FROM h9)
SELECT file, pos, name, clean_name,
  row_number() OVER (PARTITION BY file, clean_name ORDER BY pos) = 1 AS keep, length(clean_name) >= 59 AS too_long
FROM h10"""


ORACLE["q_sanitize_names"] = _clean_names(messy_names())


def _shorten():
    from .plans.cleaners import CARDIAC_SURGERY_ABBREVIATIONS
    src = f"SELECT file, pos, 'Renal disease at the time of surgery ' || name AS name FROM ({messy_names()})"
    return _clean_names(src, CARDIAC_SURGERY_ABBREVIATIONS)


ORACLE["q_shorten_names"] = _shorten()

ORACLE["q_split_name"] = r"""
SELECT p_partkey, raw, split_part(raw, '.', 1) AS dataset, string_split(raw, '.')[-1] AS tablename,
  replace(replace(regexp_replace(lower(raw), '\.csv$', ''), ' ', '_'), '-', '_') AS sanitized
FROM (SELECT p_partkey, replace(lower(p_brand), '#', '') || '.' || p_type
        || CASE WHEN p_partkey % 2 = 0 THEN '.csv' ELSE '' END AS raw FROM part)"""


# ---- sources, sinks, quality --------------------------------------------------------------------

ORACLE["q_row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS rowcount FROM {t}" for t in SUPPLIED_COLUMNS)


_FP_CELLS = " || ".join(f"'{c}=' || coalesce(length({v}) || ':' || {v}, 'null') || ';'" for c, v in sorted({
    "o_orderkey": "CAST(o_orderkey AS VARCHAR)", "o_orderstatus": "o_orderstatus",
    "cents": "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)", "day": "strftime(o_orderdate, '%Y-%m-%d')"}.items()))
_FP_CHECKSUM = ("CAST(sum(CAST('0x' || substr(h, 1, 16) AS UBIGINT)) AS VARCHAR) || '-' || "
                "CAST(sum(CAST('0x' || substr(h, 17) AS UBIGINT)) AS VARCHAR) AS checksum")


def _customer_files(where=""):
    return (f"SELECT 'cust_' || CAST(o_custkey AS VARCHAR) || '.csv' AS filename, count(*) AS rowcount, {_FP_CHECKSUM} "
            f"FROM (SELECT *, md5({_FP_CELLS}) AS h FROM orders {where}) GROUP BY 1")


ORACLE["q_ledger_anti"] = f"""
SELECT c.* FROM ({_customer_files()}) c
WHERE NOT EXISTS (SELECT 1 FROM ({_customer_files("WHERE o_orderstatus <> 'P'")}) l
                  WHERE l.filename = c.filename AND l.checksum = c.checksum)"""

ORACLE["q_ledger_purge"] = f"""
SELECT * FROM (SELECT *, {pick("CAST(regexp_extract(filename, '(\\d+)', 1) AS BIGINT)", ['cis.cag', 'ehr.patient', 'ecg.muse', 'cis.echo'])} AS tablename
               FROM ({_customer_files()}))
WHERE NOT contains(tablename, 'cis')"""

ORACLE["q_sql_script"] = Q.SCRIPT
ORACLE["q_csv_round_trip"] = "SELECT * FROM orders"
ORACLE["q_json_round_trip"] = "SELECT * FROM orders"
ORACLE["q_final_overwrite"] = "SELECT * FROM orders"
ORACLE["q_stage_append"] = "SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'a' ELSE 'b' END AS source FROM orders"
ORACLE["q_stage_rerun"] = """
WITH present AS (
  SELECT * FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderstatus = 'F'
  UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT * FROM orders WHERE o_orderkey % 5 = 0)
SELECT *, count(*) AS n_sources FROM present GROUP BY ALL"""
ORACLE["q_content_digest"] = """
WITH lines AS (SELECT o_orderkey || '|' || o_orderstatus || '|' || coalesce(o_orderpriority, '') AS line,
                 row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders),
h AS (SELECT i, length(line) + 1 AS bytes, md5(line) AS d FROM lines),
w AS (SELECT i, bytes, CAST('0x' || substr(d, 1, 8) AS UBIGINT) % 2147483647 AS a, CAST('0x' || substr(d, 9, 8) AS UBIGINT) % 2147483647 AS b,
        CAST('0x' || substr(d, 17, 8) AS UBIGINT) % 2147483647 AS c, CAST('0x' || substr(d, 25, 8) AS UBIGINT) % 2147483647 AS e FROM h)
SELECT count(*) AS lines, CAST(sum(bytes) AS BIGINT) AS length, sha256(concat_ws(':', CAST(sum(bytes) AS BIGINT), count(*),
    CAST(sum(a) AS HUGEINT) % 2147483647, CAST(sum(b) AS HUGEINT) % 2147483647, CAST(sum(c) AS HUGEINT) % 2147483647, CAST(sum(e) AS HUGEINT) % 2147483647,
    CAST(sum(i * a) AS HUGEINT) % 2147483647, CAST(sum(i * b) AS HUGEINT) % 2147483647,
    CAST(sum(i * c) AS HUGEINT) % 2147483647, CAST(sum(i * e) AS HUGEINT) % 2147483647)) AS checksum FROM w"""

ORACLE["q_script_folder"] = """
SELECT l_returnflag || ';' || l_linestatus AS status, count(*) AS n_lines, sum(l_quantity) AS sum_qty FROM lineitem GROUP BY 1"""

ORACLE["q_hot_join"] = """
SELECT l.l_orderkey, l.l_linenumber, l.hot_supplier, s.s_name
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN 1 ELSE l_suppkey END AS hot_supplier FROM lineitem) l
LEFT JOIN supplier s ON l.hot_supplier = s.s_suppkey"""

ORACLE["q_stream_commit"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS o_clerk FROM orders"""

ORACLE["q_strip_prefix"] = "SELECT event_id, value AS samplingrate, user_id AS channels, event_type FROM events"


def _code_violations():
    raw = f"coalesce(r.raw_code, e.primary_diagnosis)"
    clean = numeric_code("raw")
    return rf"""
WITH e AS ({encounter_input()}),
r AS (SELECT CASE WHEN o_orderkey % 2 = 1 THEN 'edw_' ELSE 'hosp_' END || CAST(o_orderkey AS VARCHAR) AS visit_id,
        {code_text('o_orderkey', 'o_custkey')} AS raw_code FROM orders),
d AS (SELECT e.visit_id AS key, e.db_source, e.secondary_diagnosis, {raw} AS raw FROM e LEFT JOIN r ON e.visit_id = r.visit_id),
c AS (SELECT *, {clean} AS clean FROM d),
c2 AS (SELECT *, CASE WHEN db_source = 'edw' THEN concat_ws(',', regexp_replace(clean, '\.0(,|$)', '\1', 'g'),
          regexp_replace(secondary_diagnosis, '\.0(,|$)', '\1', 'g'))
          WHEN db_source = 'dts' THEN concat_ws(',', clean, secondary_diagnosis) ELSE '' END AS combined FROM c)
SELECT key, 'Q8_unparseable_code' AS rule, raw AS value FROM c2 WHERE raw IS NOT NULL AND clean IS NULL
UNION ALL SELECT key, 'Q3_code_not_integer', clean FROM c2 WHERE contains(clean, 'e') OR contains(clean, '.')
UNION ALL SELECT key, 'Q4_combined_has_dot', combined FROM c2 WHERE contains(combined, '.')"""


ORACLE["q_code_violations"] = _code_violations()

ORACLE["q_date_violations"] = f"""
SELECT "Study Num" AS key, 'Procedure Date' AS "column", v AS value
FROM (SELECT "Study Num", CASE WHEN "Procedure Date" = '00/00/00' THEN NULL WHEN length(IDRef) % 3 = 0 THEN '31/31/2020'
        ELSE "Procedure Date" END AS v FROM ({cis_raw()}))
WHERE v IS NOT NULL AND {parse_mixed('v')} IS NULL"""

ORACLE["q_row_parity"] = " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS staged_rows, count(*) AS loaded_rows, true AS ok FROM {t}"
    for t in ["orders", "customer", "part"])


def _export_date(tbl, string_cols, ts_cols):
    now = f"TIMESTAMP '{Q.EXPORT_NOW}'"
    cands = []
    for c in string_cols:
        v = (f"CASE WHEN length({c}) - length(replace({c}, '-', '')) >= 2 OR length({c}) - length(replace({c}, '/', '')) >= 2 "
             f"THEN {parse_mixed(c)} END")
        cands.append(f"CASE WHEN {v} <= {now} THEN {v} END")
    cands += [f"CASE WHEN {c} <= {now} THEN {c} END" for c in ts_cols]
    return f"SELECT '{tbl}' AS \"table\", strftime(coalesce(max(greatest({', '.join(cands)})), {now}), '%d-%m-%Y') AS export_date"


ORACLE["q_export_date"] = (
    _export_date("orders", ["o_orderstatus", "o_orderpriority", "note"], ["o_orderdate"])
    + " FROM (SELECT *, strftime(o_orderdate, '%m/%d/%Y') AS note FROM orders) UNION ALL "
    + _export_date("events", ["event_type", "props"], ["ts"]) + " FROM events")

ORACLE["q_fingerprint"] = f"""
SELECT 'orders' AS "table", count(*) AS rowcount, {_FP_CHECKSUM} FROM (SELECT md5({_FP_CELLS}) AS h FROM orders)"""


# ---- per-source cleaners ------------------------------------------------------------------------

def py_simple_name(n: str) -> str:
    """Python statement of the simple column-name rule (for expected names in oracles)."""
    import re
    x = re.sub(r"[ .]+", "_", n.strip().lower())
    x = re.sub(r"[^a-z0-9_]", "", x)
    return x[:-1] if x.endswith("_") else x


def to_ts(x):
    return parse_mixed(f"CAST({x} AS VARCHAR)")


ORACLE["q_clean_ehr_problem_list"] = """
SELECT mrn_sha1 AS subject_id, "Problem Name" AS problem_name, Status AS status, noted_dt
FROM (SELECT DISTINCT 'mrn_' || CAST(o_custkey AS VARCHAR) AS mrn_sha1, o_orderpriority AS "Problem Name",
        o_orderstatus AS Status, strftime(o_orderdate, '%Y-%m-%d') AS noted_dt FROM orders)"""

ORACLE["q_clean_ehr_radiology"] = f"""
SELECT mrn_sha1 AS subject_id, id AS radiology_id, examination_dt, investigation_type AS examination_type,
  investigation_name AS examination_name, reason_for_investign AS indication, item_code AS report_type,
  item_comment AS report_text, abnormal_flag_code AS result_flag, accession_num
FROM (SELECT DISTINCT 'mrn_' || CAST(user_id AS VARCHAR) AS mrn_sha1, event_id AS id,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS examination_dt, {pick('event_id', ['XR', 'CT', 'MRI'])} AS investigation_type,
        event_type AS investigation_name, {pick('event_id', ['chest pain', 'sob'])} AS reason_for_investign,
        {pick('event_id', ['RPT', 'ADD'])} AS item_code, props AS item_comment,
        {pick('event_id', ['N', 'A'])} AS abnormal_flag_code, event_id * 7 AS accession_num, 'x' AS extra_column FROM events)"""

ORACLE["q_clean_ehr_surgery"] = f"""
SELECT mrn_sha1 AS subject_id, id AS surgery_id, src_institution AS institution, primary_operator_id AS surgeon_id,
  ot_procedure_name_code AS surgery_code, start_dt, reported_dt, doc_status AS report_status
FROM (SELECT DISTINCT 'mrn_' || CAST(o_custkey AS VARCHAR) AS mrn_sha1, o_orderkey AS id,
        {pick('o_orderkey', ['NUH', 'AH'])} AS src_institution, o_orderkey % 40 AS primary_operator_id,
        {pick('o_orderkey', ['CABG', 'AVR', 'MVR'])} AS ot_procedure_name_code, strftime(o_orderdate, '%Y-%m-%d') AS start_dt,
        strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS reported_dt, o_orderstatus AS doc_status FROM orders)"""

ORACLE["q_clean_concept_diagnosis_codes"] = """
SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS code, p_name AS description, p_type AS category_name FROM part"""

_LAB_PARTS = _lab_union().split("UNION ALL\n")
ORACLE["q_clean_ehr_dts_laboratory"] = _LAB_PARTS[0]
ORACLE["q_clean_ehr_edw_laboratory"] = _LAB_PARTS[1].replace(
    "CAST(CASE WHEN regexp_matches(COLLECTION_DATE_SID", "(CASE WHEN regexp_matches(COLLECTION_DATE_SID").replace(
    "CAST(CASE WHEN regexp_matches(RESULT_TEST_DATE", "(CASE WHEN regexp_matches(RESULT_TEST_DATE").replace(
    "'%Y%m%d') END AS VARCHAR)", "'%Y%m%d') END)").replace("'%Y-%m-%d') END AS VARCHAR)", "'%Y-%m-%d') END)").replace(
    "SELECT e.mrn_sha1, REQ_LOCATION,", "SELECT e.mrn_sha1 AS subject_id, REQ_LOCATION AS location,").replace(
    "SHORTTEXT, TEST_RESULTS, UNITS, NULL", "SHORTTEXT AS investigation_item, TEST_RESULTS AS numeric_value, "
    "UNITS AS numeric_value_uom, CAST(NULL AS VARCHAR) AS text_value").replace(
    "'%Y%m%d') END),", "'%Y%m%d') END) AS specimen_collected_dt,").replace(
    "'%Y-%m-%d') END),", "'%Y-%m-%d') END) AS report_dt,")

ORACLE["q_clean_ehr_encounter"] = f"""
SELECT visit_id, mrn_sha1 AS subject_id, encounter_type, db_source, {numeric_code('primary_diagnosis')} AS primary_diagnosis,
  secondary_diagnosis, visit_date, location, sub_location, visit_outcome
FROM (SELECT DISTINCT * FROM ({encounter_input()}))"""


def _patient_clean():
    from .plans.cleaners import PATIENT_COLUMNS
    sel = []
    for c in PATIENT_COLUMNS:
        if c == "mrn_sha1":
            sel.append("mrn_sha1 AS subject_id")
        elif c == "dob":
            sel.append(f"{to_ts('dob')} AS date_of_birth")
        elif c == "death_indicator":
            sel.append(f"{to_ts('death_indicator')} AS date_of_death")
        elif c == "gender":
            sel.append(f"{recode('gender', L.GENDER_RECODE)} AS gender")
        elif c == "ethnicity_race":
            sel.append(f"{recode('ethnicity_race', L.ETHNICITY_RECODE)} AS ethnicity")
        elif "dt" in c or "onset" in c:
            sel.append(f"{to_ts(c)} AS {c}")
        else:
            sel.append(c)
    return f"SELECT {', '.join(sel)} FROM (SELECT DISTINCT * FROM ({patient_input()}))"


ORACLE["q_clean_ehr_patient"] = _patient_clean()


def _vitals_clean():
    from .plans.cleaners import VITALS_COLUMNS
    raw = ["'mrn_' || CAST(user_id AS VARCHAR) AS mrn_sha1", "strftime(ts, '%Y-%m-%d %H:%M:%S') AS recorded_dt"]
    for i, c in enumerate(VITALS_COLUMNS[2:]):
        raw.append(f"CASE WHEN (event_id + {i}) % 7 = 0 THEN '\"\"\"\"' WHEN (event_id + {i}) % 7 = 1 THEN '' "
                   f"ELSE {lit(c[:3])} || CAST(event_id % 97 AS VARCHAR) END AS {ident(c)}")
    out = []
    for c in VITALS_COLUMNS:
        name = "subject_id" if c == "mrn_sha1" else py_simple_name(c)
        out.append(f"CASE WHEN {ident(c)} IN ('\"\"\"\"', '') THEN NULL ELSE {ident(c)} END AS {name}")
    return f"SELECT {', '.join(out)} FROM (SELECT DISTINCT {', '.join(raw)} FROM events)"


ORACLE["q_clean_ehr_vitals"] = _vitals_clean()

ORACLE["q_clean_ccd_ohca"] = f"""
SELECT mrn_sha1 AS subject_id, d AS date_of_arrival_at_ed, t AS time_of_arrival_at_ed,
  {parse_mixed('dis', True)} AS date_of_discharge_or_death, Outcome AS outcome,
  {parse_mixed("(d || ' ' || t)", True)} AS arrival_dt
FROM (SELECT mrn_sha1, d, {pad_seconds('t0')} AS t, dis, Outcome
      FROM (SELECT DISTINCT 'mrn_' || CAST(o_custkey AS VARCHAR) AS mrn_sha1, strftime(o_orderdate, '%d/%m/%Y') AS d,
              {pick('o_orderkey', Q.ARRIVAL_TIMES)} AS t0,
              {formatted_ts('o_orderdate + INTERVAL 3 DAY', 'o_custkey')} AS dis, o_orderstatus AS Outcome FROM orders))"""


def _coronary():
    gone = "c_custkey % 9 = 0"
    raw = (f"SELECT DISTINCT CASE WHEN {gone} THEN NULL ELSE c_name END AS Name, "
           f"CASE WHEN {gone} THEN NULL ELSE {redact(id_text('c_custkey'))} END AS NRIC, "
           f"CASE WHEN {gone} THEN NULL ELSE c_acctbal END AS FFR, CASE WHEN {gone} THEN NULL ELSE c_mktsegment END AS Vessel "
           f"FROM customer")
    return (f"SELECT {pseudonym('Name')} AS name, NRIC AS subject_id, FFR AS ffr, Vessel AS vessel FROM ({raw}) "
            f"WHERE NOT (Name IS NULL AND NRIC IS NULL AND FFR IS NULL AND Vessel IS NULL)")


ORACLE["q_clean_ccd_coronaryphysiology"] = _coronary()

ORACLE["q_clean_ecg_muse"] = f"""
SELECT Folder || '/' || Filename AS filename, pid AS subject_id, age AS subject_age, loc AS cart_id,
  {parse_exact("concat_ws(' ', adate, atime)", 'MM-dd-yyyy HH:mm:ss', r'^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$')} AS ecg_time,
  diag AS report, rate AS heartrate, '400' AS qtinterval, '420' AS qtc, '220' AS qrs_onset, '30' AS qrs_axis, '40' AS t_axis
FROM (SELECT DISTINCT 'MUSE_' || strftime(ts, '%Y%m') AS Folder, CAST(event_id AS VARCHAR) || '.xml' AS Filename,
        strftime(ts, '%m-%d-%Y') AS adate, CASE WHEN event_id % 31 = 0 THEN '25:61:00' ELSE strftime(ts, '%H:%M:%S') END AS atime,
        'mrn_' || CAST(user_id AS VARCHAR) AS pid, CAST(user_id % 70 AS VARCHAR) AS age, {pick('event_id', ['Ward 1', 'ED'])} AS loc,
        event_type AS diag, CAST(CAST(trunc(value * 10) AS INTEGER) AS VARCHAR) AS rate FROM events)"""


def _cis_extra(table_name):
    col = 'CAST(trunc("Contrast Volume") AS BIGINT)'
    if table_name == "cis.caglesion":
        return {"lesion": pick(col, Q.lesion_codes())}
    if table_name == "cis.echo":
        return {"finaldxcollated": pick(col, Q.VALVE_STATEMENTS)}
    return {}


def _cis_clean_extra(table_name):
    extra = _cis_extra(table_name)
    base = _cis_clean(L.PHI_COLUMNS.get(table_name))
    (name, expr), = extra.items()
    base = base.replace(f"FROM ({cis_raw()})", f"FROM (SELECT *, {expr} AS {name} FROM ({cis_raw()}))")
    base = base.replace("SELECT DISTINCT ", f"SELECT DISTINCT {name}, ", 1)
    return base.replace("\nFROM (SELECT * REPLACE", f", {name}\nFROM (SELECT * REPLACE", 1)


ORACLE["q_clean_cis_caglesion"] = _cis_clean_extra("cis.caglesion")
ORACLE["q_clean_cis_echo"] = _cis_clean_extra("cis.echo")


# ---- medication cleaners and union ----------------------------------------------------------------

def _enc(prefix):
    return (f"(SELECT TRY_CAST(replace(visit_id, '{prefix}_', '') AS BIGINT) AS v, mrn_sha1, encounter_type "
            f"FROM ({encounter_input()}) WHERE contains(visit_id, '{prefix}'))")


def _finish(name, mtype, start, end, route, instruction, dose, dose_units, freq, dur, dur_units, ts_typed=False):
    s = start if ts_typed else to_ts(start)
    e = end if ts_typed else to_ts(end)
    return (f"SELECT subject_id, {s} AS medication_start_dt, {e} AS medication_end_dt, "
            f"{recode(route, L.ROUTE_RECODE)} AS medication_route, coalesce({name}, {instruction}) AS medication_name, "
            f"{_when_contains_chain(mtype, L.MEDICATION_CLASS_RULES)} AS medication_type, {instruction} AS instruction, "
            f"{dose} AS dose, {dose_units} AS dose_units, {freq} AS frequency, {dur} AS duration, {dur_units} AS duration_units")


def _dts_medication():
    k, c = "o_orderkey", "o_custkey"
    raw = (f"SELECT DISTINCT 'mrn_' || CAST({c} AS VARCHAR) AS mrn_sha1, "
           f"concat_ws('|', {pick(k, Q.TOKEN_TEXTS[:4])}, {pick(c, ['IP', 'OP', 'DS'])}) AS medication_type, "
           f"{formatted_ts('o_orderdate', k)} AS first_start_dt, strftime(o_orderdate + INTERVAL 30 DAY, '%d/%m/%Y') AS last_end_dc_dt, "
           f"{pick(c, ['PO', 'IV', 'SC', 'NG', 'IM', None])} AS route_of_administration, "
           f"CASE WHEN {k} % 6 = 0 THEN NULL ELSE 'med ' || CAST({c} AS VARCHAR) END AS med, "
           f"CAST(({k} % 40) * 5 AS VARCHAR) AS max_dose, {pick(k, ['mg', 'mcg', 'units', 'mL'])} AS dosage_quantity_unit, "
           f"{pick(c, ['OM', 'BD', 'TDS', 'ON'])} AS frequency, CAST({k} % 90 AS VARCHAR) AS total_med_days, "
           f"'days' AS duration_units FROM orders")
    mt = "array_to_string(list_sort(list_distinct(string_split(medication_type, '|'))), '|')"
    fin = _finish("med", mt, "first_start_dt", "last_end_dc_dt", "route_of_administration", "CAST(NULL AS VARCHAR)",
                  "max_dose", "dosage_quantity_unit", "frequency", "total_med_days", "duration_units")
    return f"{fin} FROM (SELECT mrn_sha1 AS subject_id, * FROM ({raw}))"


def _dts_discharge():
    raw = (f"SELECT DISTINCT l_orderkey AS discharge_summary_id, strftime(l_shipdate, '%m/%d/%Y') AS medication_start_dt, "
           f"strftime(l_shipdate + INTERVAL 5 DAY, '%Y-%m-%d') AS medication_end_dt, "
           f"{pick('l_partkey', ['PO', 'IV', 'SC', 'NG', 'IM', 'PR'])} AS discharge_route, "
           f"CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'drug ' || CAST(l_partkey AS VARCHAR) END AS medication_name, "
           f"{instruction_text()} AS medication_dosage_regimen FROM lineitem")
    dose, freq, dur = instruction_fields("s")
    d1, d2 = split_first_space("dose")
    u1, u2 = split_first_space("duration")
    fin = _finish("medication_name", "'discharge'", "medication_start_dt", "medication_end_dt", "discharge_route", "s",
                  d1, d2, "frequency", u1, u2)
    return f"""
{fin}
FROM (SELECT *, {dose} AS dose, {freq} AS frequency, {dur} AS duration
      FROM (SELECT r.*, e.mrn_sha1 AS subject_id, {parse_instruction('medication_dosage_regimen')} AS s
            FROM ({raw}) r JOIN {_enc('hosp')} e ON r.discharge_summary_id = e.v))"""


def _edw_outpatient():
    raw = (f"SELECT DISTINCT l_orderkey AS ENC_KEY, strftime(l_shipdate, '%Y-%m-%d') AS CREATION_DATE_KEY, "
           f"'drug ' || CAST(l_partkey AS VARCHAR) AS DRUG_NAME, {instruction_text()} AS ORDER_INSTRUCTION_DESC, "
           f"{dose_text('l_partkey', 'l_linenumber')} AS DRUG_STRENGTH_AMT, {pick('l_suppkey', Q.INSTR_FREQ)} AS ORDER_FREQUENCY_DESC, "
           f"{duration_text('(l_orderkey + l_linenumber)', 'l_partkey')} AS ORDER_DURATION_DESC FROM lineitem")
    a, u = split_first_space("lower(ORDER_DURATION_DESC)")
    d1, d2 = last_number("DRUG_STRENGTH_AMT", "full")
    n = (f"(CASE WHEN amount IN ({', '.join(lit(c) for c in L.CYCLE_RANGES)}) THEN 1.0 ELSE TRY_CAST(amount AS DOUBLE) END)"
         f" * {unit_days('unit')}")
    fin = _finish("DRUG_NAME", "encounter_type", "st", "st + to_microseconds(CAST(coalesce(" + n + ", 0.0) * 86400000000 AS BIGINT))",
                  "CAST(NULL AS VARCHAR)", "ORDER_INSTRUCTION_DESC", d1, d2, "ORDER_FREQUENCY_DESC", "amount", "unit",
                  ts_typed=True)
    return f"""
{fin}
FROM (SELECT r.*, e.mrn_sha1 AS subject_id, e.encounter_type, {to_ts('CREATION_DATE_KEY')} AS st, {a} AS amount, {u} AS unit
      FROM ({raw}) r JOIN {_enc('edw')} e ON r.ENC_KEY = e.v)"""


def _edw_medication():
    raw = (f"SELECT DISTINCT l_orderkey AS ENC_KEY, {formatted_ts('l_shipdate', 'l_linenumber * 3')} AS STARTTIME, "
           f"strftime(l_shipdate + INTERVAL 2 DAY + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS ENDTIME, "
           f"{pick('l_partkey', ['PO', 'IV', 'SC', 'NG'])} AS ROUTECODE, "
           f"CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'order ' || CAST(l_partkey AS VARCHAR) END AS ORDERTEXT, "
           f"{instruction_text()} AS MEDICATION, "
           f"{pick('l_suppkey', Q.INSTR_SPECIAL + ['2 puffs BD for 3 days'])} AS DOSAGEREGIMEN, "
           f"CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE {pick('l_partkey', ['OD', 'BD', 'TDS'])} END AS FREQUENCY1CODE "
           f"FROM lineitem")
    da, fa, _ = instruction_fields("sa")
    db, fb, _ = instruction_fields("sb")
    d1, d2 = last_number("dose0", "full")
    dur = (f"CAST(CAST(floor(date_diff('microsecond', {to_ts('STARTTIME')}, {to_ts('ENDTIME')}) / 86400000000) AS BIGINT) "
           f"AS VARCHAR)")
    fin = _finish("ORDERTEXT", "encounter_type", "STARTTIME", "ENDTIME", "ROUTECODE", "MEDICATION", d1, d2, "freq0", dur,
                  "'days'")
    return f"""
{fin}
FROM (SELECT *, coalesce({da}, {db}) AS dose0, coalesce(FREQUENCY1CODE, {fa}, {fb}) AS freq0
      FROM (SELECT r.*, e.mrn_sha1 AS subject_id, e.encounter_type, {parse_instruction('MEDICATION')} AS sa,
              {parse_instruction('CAST(DOSAGEREGIMEN AS VARCHAR)')} AS sb
            FROM ({raw}) r JOIN {_enc('edw')} e ON r.ENC_KEY = e.v))"""


ORACLE["q_clean_ehr_dts_medication"] = _dts_medication()
ORACLE["q_clean_ehr_dts_discharge_medication"] = _dts_discharge()
ORACLE["q_clean_ehr_edw_outpatient_medication"] = _edw_outpatient()
ORACLE["q_clean_ehr_edw_medication"] = _edw_medication()
ORACLE["q_med_union"] = "\nUNION ALL\n".join(
    ORACLE[f"q_clean_ehr_{s}"] for s in ["dts_discharge_medication", "dts_medication", "edw_medication",
                                         "edw_outpatient_medication"])


ORACLE["q_stream_ingest"] = "SELECT * FROM orders"   # Comments is a cis.cag PHI column: dropped

_CARDIAC_NAMES = {  # expected clean names (long-name branch applies to the whole file)
    "Renal disease at the time of surgery (choice=Functioning transplant)": "renal_disease_functioning_transplant",
    "Other cardiac procedures (choice=Subaortic stenosis resection)": "other_cardiacsurg_sasr",
    "Atrial fibrillation correction surgery (choice=Left atrial maze)": "af_surgery_la_maze",
    "PreOperative.Status/Ejection fraction (choice=Moderate 31-50%)": "pre_operative_status_ejection_fraction_choicemoderate_3150",
}


def _cardiac():
    longs = ", ".join(f"{pick('o_orderkey + ' + str(i), ['Checked', 'Unchecked'])} AS {ident(h)}"
                      for i, h in enumerate(Q.CARDIAC_LONG_HEADERS))
    raw = (f"SELECT DISTINCT 'mrn_' || CAST(o_custkey AS VARCHAR) AS mrn_sha1, strftime(o_orderdate, '%m/%d/%Y') AS \"Date of Surgery\", "
           f"strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS \"Date and Time of Admission\", "
           f"{formatted_ts('o_orderdate', 'o_orderkey')} AS date_and_time_of_operation, "
           f"strftime(o_orderdate + INTERVAL 9 DAY, '%d/%m/%Y') AS date_and_time_of_discharge_or_death, "
           f"o_totalprice AS \"EuroSCORE II\", {longs} FROM orders")
    outs = ["mrn_sha1 AS subject_id", f"{to_ts(ident('Date of Surgery'))} AS date_of_surgery",
            f"{to_ts(ident('Date and Time of Admission'))} AS date_and_time_of_admission",
            f"{to_ts('date_and_time_of_operation')} AS date_and_time_of_operation",
            f"{to_ts('date_and_time_of_discharge_or_death')} AS date_and_time_of_discharge_or_death",
            '"EuroSCORE II" AS euro_score_ii'] + [f"{ident(h)} AS {n}" for h, n in _CARDIAC_NAMES.items()]
    return f"SELECT {', '.join(outs)} FROM ({raw})"


ORACLE["q_clean_ccd_cardiacsurgery"] = _cardiac()


def _iecg():
    P = "restingecgdata/"
    S = P + "interpretations/interpretation/statement"
    lst = ("CASE WHEN event_id % 5 = 0 THEN 'not a list' WHEN event_id % 5 = 1 THEN NULL ELSE "
           f"'[{{''leftstatement'': ''Sinus rhythm'', ''rightstatement'': ''' || {pick('event_id', ['Normal ECG', 'Borderline', 'Abnormal'])} "
           "|| '''}, {''leftstatement'': ''' || event_type || ''', ''rightstatement'': ''Rate ''}]' END")
    raw = [
        ("filename", "'C:\\ecg\\' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id AS VARCHAR) || '.xml'"),
        ("d", "strftime(ts, '%Y-%m-%d')"), ("t", "strftime(ts, '%H:%M:%S')"), ("lst", lst),
        ("lft", pick("event_id", ["Normal sinus rhythm", "", None, "Left axis deviation"])),
        ("rgt", pick("event_id * 3", ["Normal ECG", "Abnormal ECG", ""])),
        ("hp", pick("event_id", ["0.05", "0.15", None])), ("lp", pick("event_id", ["150", "40", "100"])),
        ("notch", pick("event_id", ["50", None, "60"])), ("art", pick("event_id", ["true", "false"])),
        ("hys", pick("event_id * 7", ["True", "False", None])), ("hr", "CAST(value AS VARCHAR)"),
        ("qt", "CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(CAST(trunc(value * 40) AS INTEGER) AS VARCHAR) END"),
        ("qtc", "CAST(CAST(trunc(value * 41) AS INTEGER) AS VARCHAR)"),
        ("pid", "'mrn_' || CAST(user_id AS VARCHAR)"), ("age", "CAST(user_id % 60 AS VARCHAR)"),
        ("cart", pick("event_id", ["cart 1", "cart 2"])),
    ]
    raw_sql = "SELECT DISTINCT " + ", ".join(f"{e} AS {n}" for n, e in raw) + " FROM events"
    js = "CASE WHEN json_valid(replace(lst, '''', '\"')) THEN from_json(replace(lst, '''', '\"'), " \
         "'[{\"leftstatement\":\"VARCHAR\",\"rightstatement\":\"VARCHAR\"}]') END"
    pairs = ("coalesce(list_transform(js, lambda x: lower(x.leftstatement) || '; ' || lower(x.rightstatement)), "
             "CAST([] AS VARCHAR[]))")
    report = (f"array_to_string(list_sort(list_distinct(list_filter(list_concat({pairs}, "
              f"[lower(coalesce(rgt, '')), lower(coalesce(lft, ''))]), lambda x: x <> ''))), '; ')")
    truthy = lambda x: f"coalesce(lower(trim({x})) IN ('true', '1', '1.0', 'yes', 'y', 't'), false)"
    stem = r"split_part(string_split(filename, '\')[-1], '.xml', 1)"
    outs = [
        "filename", "pid AS subject_id", "CAST(NULL AS VARCHAR) AS subject_dob", "age AS subject_age",
        f"{pseudonym(stem, 30)} AS study_id", "cart AS cart_id",
        f"{parse_exact("concat_ws(' ', d, t)", 'yyyy-MM-dd HH:mm:ss', _ISO_GUARD)} AS ecg_time",
        f"{report} AS report", "hp || '-' || lp || 'Hz' AS bandwidth", "hp AS highpassfilter", "lp AS lowpassfilter",
        f"CASE WHEN notch IS NOT NULL THEN notch || ' Hz notch' ELSE '' END || CASE WHEN {truthy('art')} THEN 'Artifact filter' "
        f"ELSE '' END || CASE WHEN {truthy('hys')} THEN 'Hysteresis filter' ELSE '' END AS filtering",
        "notch AS notchfilterfreqs", "art AS artifactfilter", "hys AS hysteresisfilter",
        "TRY_CAST(hr AS DOUBLE) AS heartrate", "TRY_CAST(qt AS DOUBLE) AS qtinterval", "TRY_CAST(qtc AS DOUBLE) AS qtc",
        "'500' AS samplingrate", "'12' AS numberchannelsvalid", "'800' AS rr_interval", "CAST('48' AS DOUBLE) AS qrs_onset",
        "'60' AS p_axis", "'30' AS qrs_axis", "'45' AS t_axis"]
    return f"SELECT {', '.join(outs)} FROM (SELECT *, {js} AS js FROM ({raw_sql}))"


ORACLE["q_clean_ecg_iecg"] = _iecg()

ORACLE["q_data_dictionary"] = f"""
SELECT table_schema, table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position, data_type,
  CAST(character_maximum_length AS INTEGER) AS character_maximum_length,
  CAST(numeric_precision AS INTEGER) AS numeric_precision, is_nullable, CAST(column_default AS VARCHAR) AS column_default
FROM information_schema.columns
WHERE table_name IN ({', '.join(lit(t) for t in SUPPLIED_COLUMNS)}) AND table_schema NOT LIKE 'staging_%'"""


# Cleaners de-duplicate their output (R1 after cleaning): the oracle of every cleaner query is its
# statement under SELECT DISTINCT, and the unions are UNION ALL of de-duplicated sources.
for _k in [k for k in ORACLE if k.startswith("q_clean_") or k == "q_cis_clean"]:
    ORACLE[_k] = f"SELECT DISTINCT * FROM ({ORACLE[_k]}\n)"
ORACLE["q_med_union"] = "\nUNION ALL\n".join(
    ORACLE[f"q_clean_ehr_{s}"] for s in ["dts_discharge_medication", "dts_medication", "edw_medication",
                                         "edw_outpatient_medication"])
ORACLE["q_lab_union"] = ORACLE["q_clean_ehr_dts_laboratory"] + "\nUNION ALL\n" + ORACLE["q_clean_ehr_edw_laboratory"]

ORACLE["q_csv_records"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
       o_orderstatus || chr(10) || '"' || CAST(o_custkey AS VARCHAR) || '",' || chr(10) || CAST(o_orderkey AS VARCHAR) AS note,
       CAST(o_custkey AS VARCHAR) AS customer
FROM orders"""
