"""The per-source cleaners as declarative specifications.

Every cleaner runs: its own step -> date coercion (D1/D2) -> column names (M9-M13) -> dedup (R1).
The original de-duplicates before and after cleaning; every step is deterministic per row
(projections, parsing, joins), so dedup(step(dedup(x))) == dedup(step(x)) and one dedup after
cleaning gives the same rows with one shuffle over the narrower cleaned rows.  A step is a plain ``DataFrame -> DataFrame`` function of Spark expressions; the
context carries the shared encounter table (for the joins J1/J2) and the pseudonym secret.
Absent optional columns are tolerated; null in gives null out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import lookups as L
from ..functions import dates as D
from ..functions import text as X
from ..functions._util import recode
from ..functions.codes import numeric_code
from ..functions.deid import file_stem, pseudonym
from ..operators.joins import spread_join
from ..operators.rows import dedup, dedup_packed, drop_all_null, pack_text
from ..operators.schema import apply_clean_names


@dataclass
class Context:
    encounters: DataFrame | None = None   # preprocessed ehr.encounter (visit_id, mrn_sha1, encounter_type)
    hot_share: float | None = None   # measure visits with more than this share of the rows and deal them to several tasks
    secret: dict = field(default_factory=lambda: dict(L.TEST_SECRET))


@dataclass
class CleanerSpec:
    source: str
    step: Callable[[DataFrame, Context], DataFrame] | None = None
    destination: str | None = None
    dt_cols: list[str] = field(default_factory=list)
    dt_formats: dict[str, str] = field(default_factory=dict)
    abbreviations: dict[str, str] = field(default_factory=dict)
    joins_encounters: bool = False   # the step reads Context.encounters
    packed: bool = False   # many short texts: packed for the shuffle of the dedup

    @property
    def target(self) -> str:
        return self.destination or self.source


def _c(name: str):
    return F.col(f"`{name}`")


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def coerce_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Coerce the listed columns to timestamps.  The parser is applied to all text columns through
    one higher-order ``transform`` over an array of them, so generated code stays far below the
    JVM's 64 KB method limit (27 inlined parsers do not)."""
    from pyspark.sql import types as T
    present = [c for c in cols if _has(df, c)]
    text = [c for c in present if not isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    typed = {c: D.coerce_ts(df, c) for c in present if c not in text}
    if not text:
        return df.withColumns(typed) if typed else df
    arr = "__dates"
    df = df.withColumn(arr, F.transform(F.array(*[_c(c).cast("string") for c in text]), lambda v: D.parse_mixed(v)))
    return df.withColumns({**typed, **{c: F.col(arr)[i] for i, c in enumerate(text)}}).drop(arr)


def clean(df: DataFrame, spec: CleanerSpec, ctx: Context | None = None, strict_names: bool = True) -> DataFrame:
    ctx = ctx or Context()
    if spec.step is not None:
        df = spec.step(df, ctx)
    if spec.dt_formats:
        df = df.withColumns({c: D.parse_exact(_c(c).cast("string"), f) for c, f in spec.dt_formats.items()
                             if _has(df, c)})
    else:
        df = coerce_dates(df, spec.dt_cols)
    return (dedup_packed if spec.packed else dedup)(apply_clean_names(df, spec.abbreviations, strict=strict_names))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if _has(df, k)})


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[_c(c) if _has(df, c) else F.lit(None).cast("string").alias(c) for c in cols])


def encounters_for(ctx: Context, system: str) -> DataFrame:
    """Encounters of one source system with the numeric visit key ('edw_12' -> 12)."""
    prefix = "hosp" if system == "dts" else "edw"
    enc = ctx.encounters
    return (enc.filter(F.col("visit_id").contains(prefix))
            .select(F.replace(F.col("visit_id"), F.lit(prefix + "_"), F.lit("")).try_cast("bigint").alias("_visit"),
                    "mrn_sha1", "encounter_type"))


def join_encounters(df: DataFrame, ctx: Context, key: str, system: str, how: str = "inner",
                    keep: list[str] | None = None) -> DataFrame:
    """Equi-join on the visit key.  Null keys fall out of inner joins and stay (unmatched) in left joins, dealt
    to several tasks.  Visits with more than ``ctx.hot_share`` of the rows are too.

    Without ``keep`` AQE picks a broadcast join when the encounter side is measured small, else sort-merge.
    With ``keep``, the columns of ``df`` that are read afterwards, only those go on, their texts packed for the shuffle, and the
    join is sort-merge at every size: the encounters grow with the input and never pass whole through the driver."""
    enc = encounters_for(ctx, system)
    keyed = df.withColumn("_key", _c(key).try_cast("bigint"))
    if keep is None:
        return spread_join(keyed, enc, "_key", "_visit", how, hot_share=ctx.hot_share).drop("_key", "_visit")
    names = {c.lower() for c in keep}
    packed, unpack = pack_text(keyed.select("_key", *[_c(c) for c in df.columns if c.lower() in names]))
    return unpack(spread_join(packed, enc.hint("merge"), "_key", "_visit", how, hot_share=ctx.hot_share)).drop("_key", "_visit")


# ---- ccd -----------------------------------------------------------------------------------------

def ohca_step(df, ctx):
    t = D.pad_seconds(_c("Time of arrival at ED"))
    df = df.withColumn("Time of arrival at ED", t)
    df = df.withColumn("arrival_dt", D.parse_mixed(F.concat(_c("Date of arrival at ED"), F.lit(" "), t), dayfirst=True))
    df = df.withColumn("Date of Discharge or Death", D.parse_mixed(_c("Date of Discharge or Death"), dayfirst=True))
    return rename(df, {"mrn_sha1": "subject_id", "Time of arrival at ED": "time_of_arrival_at_ed",
                       "Date of arrival at ED": "date_of_arrival_at_ed",
                       "Date of Discharge or Death": "date_of_discharge_or_death"})


CARDIAC_SURGERY_ABBREVIATIONS = {
    "renal_disease_at_the_time_of_surgery_choicefunctioning_transplant": "renal_disease_functioning_transplant",
    "renal_disease_at_the_time_of_surgery_choicecreatinine_200_umol_per_l": "renal_disease_cr_200_umol_per_l",
    "renal_disease_at_the_time_of_surgery_choicedialysis_acute_renal_failure": "renal_disease_aki",
    "renal_disease_at_the_time_of_surgery_choicedialysis_chronic_renal_failure": "renal_disease_crf",
    "other_cardiac_procedures_choicearrythmia_correction_surgery": "other_cardiacsurg_arrhythmia",
    "other_cardiac_procedures_choicepulmonary_thromboembolectomy": "other_cardiacsurg_pte",
    "other_cardiac_procedures_choicesubaortic_stenosis_resection": "other_cardiacsurg_sasr",
    "other_cardiac_procedures_choicesurgical_ventricular_restoration": "other_cardiacsurg_svr",
    "other_cardiac_procedures_choiceasd_repair__secundum_or_sinus_venosus": "other_cardiacsurg_asdrepair",
    "other_cardiac_procedures_choiceother_procedure_not_listed_above": "other_cardiacsurg_other",
    "other_thoracic_and_vascular_procedures_choiceperipheral_vascular": "other_surg_pvd",
    "other_thoracic_and_vascular_procedures_choicecarotid_endarterectomy": "other_surg_cea",
    "other_thoracic_and_vascular_procedures_choiceother_thoracic": "other_surg_thoracic",
    "atrial_fibrillation_correction_surgery_choicepulmonary_vein_isolation_pvi": "af_surgery_pvi",
    "atrial_fibrillation_correction_surgery_choiceleft_atrial_maze": "af_surgery_la_maze",
    "atrial_fibrillation_correction_surgery_choicebiatrial_maze_la__ra": "af_surgery_ba_maze",
}


def coronary_physiology_step(df, ctx):
    df = drop_all_null(df)
    s = ctx.secret
    df = df.withColumn("Name", pseudonym(_c("Name").cast("string"), s["salt"], s["start_idx"], s["length"]))
    return rename(df, {"NRIC": "subject_id"})


# ---- cis -----------------------------------------------------------------------------------------

def cis_step(df, ctx):
    s = ctx.secret
    if _has(df, "Procedure Date"):
        df = df.withColumn("Procedure Date", F.when(_c("Procedure Date").cast("string") == L.CIS_DATE_SENTINEL, F.lit(None))
                           .otherwise(_c("Procedure Date")))
    if _has(df, "Study Num"):
        df = df.withColumn("Study Num", pseudonym(_c("Study Num"), s["salt"], s["start_idx"], s["length"]))
    df = df.drop(*[c for c in L.CIS_DROP_COLUMNS if _has(df, c)])
    aliases = [c for c in df.columns if c in L.CIS_HOSPITAL_ALIASES]
    if aliases:  # several spellings: the first in column order wins
        df = df.drop(*aliases[1:]).withColumnRenamed(aliases[0], "Hospital")
    header = ["IDRef", "Study Num"]
    if _has(df, "Procedure Date"):
        df = df.withColumn("Procedure Date", D.format_ts(D.coerce_ts(df, "Procedure Date")))
        header.append("Procedure Date")
    if _has(df, "Hospital"):
        header.append("Hospital")
    header = [h for h in header if _has(df, h)]
    df = df.select(*[_c(h) for h in header], *[_c(c) for c in df.columns if c not in header])
    return rename(df, L.CIS_RENAMES)


# ---- ecg -----------------------------------------------------------------------------------------

IECG = "restingecgdata/"
IECG_SIGNAL_PREFIX = "restingecgdata/dataacquisition/signalcharacteristics/"
IECG_RENAMES = {
    "restingecgdata/patient/generalpatientdata/patientid": "subject_id",
    "restingecgdata/patient/generalpatientdata/age/dateofbirth": "subject_dob",
    "restingecgdata/patient/generalpatientdata/age/years": "subject_age",
    "restingecgdata/dataacquisition/machine/@detaildescription": "cart_id",
    "restingecgdata/internalmeasurements/groupmeasurements/groupmeasurement/meanrrint": "rr_interval",
    "restingecgdata/internalmeasurements/crossleadmeasurements/pfrontaxis": "p_axis",
    "restingecgdata/internalmeasurements/crossleadmeasurements/qrsfrontaxis": "qrs_axis",
    "restingecgdata/internalmeasurements/crossleadmeasurements/stfrontaxis": "t_axis",
}
IECG_HEAD = ["filename", "subject_id", "subject_dob", "subject_age", "study_id", "cart_id", "ecg_time", "report",
             "bandwidth", "highpassfilter", "lowpassfilter", "filtering", "notchfilterfreqs", "artifactfilter",
             "hysteresisfilter", "heartrate", "qtinterval", "qtc"]
IECG_TAIL = ["rr_interval", "qrs_onset", "p_axis", "qrs_axis", "t_axis"]


IECG_TIME = (IECG + "dataacquisition/@date", IECG + "dataacquisition/@time")


def parse_iecg_time(text):
    return D.parse_exact(text, "yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")


def iecg_step(df, ctx):
    s = ctx.secret
    stmt = IECG + "interpretations/interpretation/statement"
    bw = IECG + "reportinfo/reportbandwidth/"
    gm = IECG + "interpretations/interpretation/globalmeasurements/"
    xm = IECG + "internalmeasurements/crossleadmeasurements/"
    df = df.withColumns({
        "study_id": pseudonym(file_stem(_c("filename")), s["salt"], s["start_idx"], 30),
        "ecg_time": parse_iecg_time(F.concat_ws(" ", *map(_c, IECG_TIME))),
        "report": X.ecg_report(_c(stmt), _c(stmt + "/rightstatement"), _c(stmt + "/leftstatement")),
        "highpassfilter": _c(bw + "highpassfiltersetting"),
        "lowpassfilter": _c(bw + "lowpassfiltersetting"),
        "bandwidth": X.bandwidth(_c(bw + "highpassfiltersetting"), _c(bw + "lowpassfiltersetting")),
        "notchfilterfreqs": _c(IECG_SIGNAL_PREFIX + "notchfilterfreqs"),
        "artifactfilter": _c(bw + "artifactfilterflag"),
        "hysteresisfilter": _c(bw + "hysteresisfilterflag"),
        "filtering": X.filter_summary(_c(IECG_SIGNAL_PREFIX + "notchfilterfreqs"), _c(bw + "artifactfilterflag"),
                                      _c(bw + "hysteresisfilterflag")),
        "heartrate": _c(gm + "heartrate/#text").try_cast("double"),
        "qtinterval": _c(xm + "meanqtint").try_cast("double"),
        "qtc": _c(xm + "meanqtc").try_cast("double"),
        "qrs_onset": _c(gm + "qonset/#text").try_cast("double"),
    })
    stripped = strip_prefix_map(df.columns, IECG_SIGNAL_PREFIX)
    df = rename(df, IECG_RENAMES)
    df = df.select(*[_c(c) for c in df.columns if c not in stripped],
                   *[_c(old).alias(new) for old, new in stripped.items()])
    cols = []
    for c in IECG_HEAD + list(stripped.values()) + IECG_TAIL:
        if c not in cols:
            cols.append(c)
    return project(df, cols)


def strip_prefix_map(columns: list[str], prefix: str) -> dict[str, str]:
    """Columns containing ``prefix`` -> name without it; a result that already exists is skipped."""
    out = {}
    for c in columns:
        if prefix in c:
            new = c.replace(prefix, "")
            if new not in columns and new not in out.values():
                out[c] = new
    return out


MUSE_RENAMES = {
    "RestingECG/PatientDemographics/PatientID": "subject_id",
    "RestingECG/PatientDemographics/PatientAge": "subject_age",
    "RestingECG/TestDemographics/LocationName": "cart_id",
    "RestingECG/OriginalDiagnosis/DiagnosisStatement": "report",
    "RestingECG/RestingECGMeasurements/VentricularRate": "heartrate",
    "RestingECG/RestingECGMeasurements/QTInterval": "qtinterval",
    "RestingECG/RestingECGMeasurements/QTCorrected": "qtc",
    "RestingECG/RestingECGMeasurements/QOnset": "qrs_onset",
    "RestingECG/RestingECGMeasurements/RAxis": "qrs_axis",
    "RestingECG/RestingECGMeasurements/TAxis": "t_axis",
}
MUSE_COLUMNS = ["filename", "subject_id", "subject_age", "cart_id", "ecg_time", "report", "heartrate",
                "qtinterval", "qtc", "qrs_onset", "qrs_axis", "t_axis"]


MUSE_TIME = ("RestingECG/TestDemographics/AcquisitionDate", "RestingECG/TestDemographics/AcquisitionTime")


def parse_muse_time(text):
    return D.parse_exact(text, "MM-dd-yyyy HH:mm:ss", r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$")


def muse_step(df, ctx):
    df = rename(df, MUSE_RENAMES)
    df = df.withColumn("filename", F.concat(_c("Folder"), F.lit("/"), _c("Filename")))
    df = df.withColumn("ecg_time", parse_muse_time(F.concat_ws(" ", *map(_c, MUSE_TIME))))
    return project(df, MUSE_COLUMNS)


# ---- ehr: medication (four sources -> ehr.medication) -------------------------------------------

def finish_medication(df):
    """Shared tail: name fallback, class, tolerant dates, route recode, 12-column shape."""
    df = project(df, L.MEDICATION_COLUMNS)
    return df.withColumns({
        "medication_name": F.coalesce(F.col("medication_name"), F.col("instruction")),
        "medication_type": X.medication_class(F.col("medication_type")),
        "medication_start_dt": D.coerce_ts(df, "medication_start_dt"),
        "medication_end_dt": D.coerce_ts(df, "medication_end_dt"),
        "medication_route": recode(F.col("medication_route"), L.ROUTE_RECODE),
    })


def dts_discharge_medication_step(df, ctx):
    names = {"mrn_sha1": "subject_id", "discharge_route": "medication_route",
             "medication_dosage_regimen": "medication_dose"}
    df = join_encounters(df, ctx, "discharge_summary_id", "dts", keep=[*names, "medication_dose", *L.MEDICATION_COLUMNS])
    df = df.withColumn("medication_type", F.lit("discharge"))
    df = rename(df, names)
    df = X.with_parsed_instruction(df, F.col("medication_dose"), "_p")
    dose, dose_units = X.split_first_space(F.col("_p.dose"))
    dur, dur_units = X.split_first_space(F.col("_p.duration"))
    df = df.withColumns({"instruction": F.col("_p.instruction"), "dose": dose, "dose_units": dose_units,
                         "frequency": F.col("_p.frequency"), "duration": dur, "duration_units": dur_units})
    return finish_medication(df)


def dts_medication_step(df, ctx):
    df = df.withColumn("medication_type", X.unique_tokens(F.col("medication_type")))
    df = rename(df, {"mrn_sha1": "subject_id", "first_start_dt": "medication_start_dt",
                     "last_end_dc_dt": "medication_end_dt", "route_of_administration": "medication_route",
                     "med": "medication_name", "max_dose": "dose", "dosage_quantity_unit": "dose_units",
                     "order_types": "medication_type", "total_med_days": "duration"})
    df = df.withColumn("instruction", F.lit(None).cast("string"))
    return finish_medication(df)


def edw_medication_step(df, ctx):
    names = {"mrn_sha1": "subject_id", "STARTTIME": "medication_start_dt", "ENDTIME": "medication_end_dt",
             "ROUTECODE": "medication_route", "ORDERTEXT": "medication_name", "MEDICATION": "instruction",
             "encounter_type": "medication_type", "FREQUENCY1CODE": "frequency"}
    df = rename(join_encounters(df, ctx, "ENC_KEY", "edw", keep=[*names, "DOSAGEREGIMEN", *L.MEDICATION_COLUMNS]), names)
    df = X.with_parsed_instruction(df, F.col("instruction"), "_a")
    df = X.with_parsed_instruction(df, F.col("DOSAGEREGIMEN").cast("string"), "_b")
    df = df.withColumns({"dose": F.coalesce(F.col("_a.dose"), F.col("_b.dose")),
                         "frequency": F.coalesce(F.col("frequency"), F.col("_a.frequency"), F.col("_b.frequency"))})
    dose, units = X.split_last_number(F.col("dose"))
    df = df.withColumns({c: D.coerce_ts(df, c) for c in ("medication_start_dt", "medication_end_dt")})   # parsed once
    df = df.withColumns({
        "dose": dose, "dose_units": units,
        "duration": D.floor_day_diff(F.col("medication_end_dt"), F.col("medication_start_dt")).cast("string"),
        "duration_units": F.lit("days")})
    return finish_medication(df)


def _unit_days(u):
    expr = None
    for name, days in L.DURATION_UNIT_DAYS.items():
        expr = F.when(u == name, F.lit(float(days))) if expr is None else expr.when(u == name, F.lit(float(days)))
    return expr


def edw_outpatient_medication_step(df, ctx):
    names = {"mrn_sha1": "subject_id", "CREATION_DATE_KEY": "medication_start_dt",
             "DRUG_NAME": "medication_name", "encounter_type": "medication_type",
             "ORDER_INSTRUCTION_DESC": "instruction", "DRUG_STRENGTH_AMT": "dose",
             "ORDER_FREQUENCY_DESC": "frequency", "ORDER_DURATION_DESC": "duration"}
    df = rename(join_encounters(df, ctx, "ENC_KEY", "edw", keep=[*names, *L.MEDICATION_COLUMNS]), names)
    df = df.withColumns({"medication_route": F.lit(None).cast("string"),
                         "medication_start_dt": D.coerce_ts(df, "medication_start_dt")})
    amount, unit = X.split_first_space(F.lower(F.col("duration")))
    dose, dose_units = X.split_last_number(F.col("dose"))
    df = df.withColumns({"duration": amount, "duration_units": unit, "dose": dose, "dose_units": dose_units})
    n = (F.when(F.col("duration").isin(*L.CYCLE_RANGES), F.lit(1.0)).otherwise(F.col("duration").try_cast("double"))
         * _unit_days(F.col("duration_units")))
    df = df.withColumn("medication_end_dt", D.add_days(F.col("medication_start_dt"), F.coalesce(n, F.lit(0.0))))
    return finish_medication(df)


# ---- ehr: lab (two sources -> ehr.lab) ------------------------------------------------------------

def dts_laboratory_step(df, ctx):
    df = rename(df, {"mrn_sha1": "subject_id", "src_institution": "location"})
    return project(df, L.LAB_COLUMNS)


def edw_laboratory_step(df, ctx):
    df = join_encounters(df, ctx, "ENC_KEY", "edw", how="left")
    df = rename(df, {"mrn_sha1": "subject_id", "REQ_LOCATION": "location", "COLLECTION_DATE_SID": "specimen_collected_dt",
                     "RESULT_TEST_DATE": "report_dt", "SHORTTEXT": "investigation_item",
                     "TEST_RESULTS": "numeric_value", "UNITS": "numeric_value_uom"})
    df = df.withColumns({
        "text_value": F.lit(None).cast("string"),
        "specimen_collected_dt": D.parse_exact(F.col("specimen_collected_dt").cast("string"), "yyyyMMdd", r"^\d{8}$"),
        "report_dt": D.parse_exact(F.col("report_dt").cast("string"), "yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$")})
    return project(df, L.LAB_COLUMNS)


# ---- ehr: others ---------------------------------------------------------------------------------

PATIENT_COLUMNS = (["mrn_sha1", "dob", "gender", "death_indicator", "ethnicity_race", "first_followup_dt",
                    "last_followup_dt", "db_source", "last_encounter_location"]
                   + [c for dx in L.COMORBIDITIES for c in (dx, f"{dx}_onset")])


def patient_step(df, ctx):
    df = project(df, PATIENT_COLUMNS)
    df = df.withColumns({"death_indicator": D.coerce_ts(df, "death_indicator"),
                         "gender": recode(F.col("gender"), L.GENDER_RECODE),
                         "ethnicity_race": recode(F.col("ethnicity_race"), L.ETHNICITY_RECODE)})
    return rename(df, {"mrn_sha1": "subject_id", "dob": "date_of_birth", "death_indicator": "date_of_death",
                       "ethnicity_race": "ethnicity"})


PATIENT_DATE_COLUMNS = ([c for c in PATIENT_COLUMNS if "dt" in c.lower() or "onset" in c.lower()]
                        + ["date_of_birth"])


def encounter_step(df, ctx):
    df = df.withColumn("primary_diagnosis", numeric_code(F.col("primary_diagnosis").cast("string")))
    return rename(df, {"mrn_sha1": "subject_id"})


RADIOLOGY = {"mrn_sha1": "subject_id", "id": "radiology_id", "examination_dt": "examination_dt",
             "investigation_type": "examination_type", "investigation_name": "examination_name",
             "reason_for_investign": "indication", "item_code": "report_type", "item_comment": "report_text",
             "abnormal_flag_code": "result_flag", "accession_num": "accession_num"}
SURGERY = {"mrn_sha1": "subject_id", "id": "surgery_id", "src_institution": "institution",
           "primary_operator_id": "surgeon_id", "ot_procedure_name_code": "surgery_code", "start_dt": "start_dt",
           "reported_dt": "reported_dt", "doc_status": "report_status"}
SURGERY_ORDER = ["mrn_sha1", "id", "src_institution", "primary_operator_id", "ot_procedure_name_code", "start_dt",
                 "reported_dt", "doc_status"]
VITALS_COLUMNS = ["mrn_sha1", "recorded_dt", "temperature", "temperature_uom", "heart_rate", "heart_rate_uom",
                  "blood_pressure", "blood_pressure_uom", "map", "map_uom", "resp_rate", "resp_rate_uom", "o2_sat",
                  "o2_sat_uom", "fiO2", "fiO2_uom", "painScore", "bp_position", "blender_fiO2_percent",
                  "blender_fio2_percent_uom", "o2_flow_rate", "o2_flow_rate_uom", "o2_device", "rad_o2_device",
                  "ed_o2_device", "ed_r_o2_device", "o2_device_humidified", "flow_rate", "flow_rate_uom"]


def vitals_step(df, ctx):
    df = project(df, VITALS_COLUMNS)
    df = df.select(*[F.when(_c(c).cast("string").isin('""""', ""), F.lit(None)).otherwise(_c(c)).alias(c)
                     for c in df.columns])
    return rename(df, {"mrn_sha1": "subject_id"})


def _rename_project(order, mapping):
    return lambda df, ctx: rename(project(df, order), mapping)


CIS_TABLES = ["cag", "caglesion", "echo", "nuclear", "pacemaker", "pci", "pcidevicesequence",
              "pcidevicesequencetimings", "pcilesionsequence", "procedure"]

CLEANERS: dict[str, CleanerSpec] = {s.source: s for s in [
    CleanerSpec("ccd.ohca", ohca_step),
    CleanerSpec("ccd.cardiacsurgery", lambda df, ctx: rename(df, {"mrn_sha1": "subject_id"}),
                dt_cols=["Date of Surgery", "Date and Time of Admission", "date_and_time_of_operation",
                         "date_and_time_of_discharge_or_death"],
                abbreviations=CARDIAC_SURGERY_ABBREVIATIONS),
    CleanerSpec("ccd.coronaryphysiology", coronary_physiology_step),
    *[CleanerSpec(f"cis.{t}", cis_step) for t in CIS_TABLES],
    CleanerSpec("concept.diagnosis_codes", None, destination="concept.diagnosis_code"),
    CleanerSpec("ecg.iecg", iecg_step, dt_cols=["ecg_time"]),
    CleanerSpec("ecg.muse", muse_step, dt_cols=["ecg_time"]),
    CleanerSpec("ehr.dts_discharge_medication", dts_discharge_medication_step, destination="ehr.medication",
                joins_encounters=True, packed=True),
    CleanerSpec("ehr.dts_medication", dts_medication_step, destination="ehr.medication", packed=True),
    CleanerSpec("ehr.edw_medication", edw_medication_step, destination="ehr.medication", joins_encounters=True, packed=True),
    CleanerSpec("ehr.edw_outpatient_medication", edw_outpatient_medication_step, destination="ehr.medication",
                joins_encounters=True, packed=True),
    CleanerSpec("ehr.dts_laboratory", dts_laboratory_step, destination="ehr.lab"),
    CleanerSpec("ehr.edw_laboratory", edw_laboratory_step, destination="ehr.lab", joins_encounters=True),
    CleanerSpec("ehr.problem_list", lambda df, ctx: rename(df, {"mrn_sha1": "subject_id"}), destination="ehr.diagnosis"),
    CleanerSpec("ehr.patient", patient_step, dt_cols=PATIENT_DATE_COLUMNS),
    CleanerSpec("ehr.encounter", encounter_step),
    CleanerSpec("ehr.radiology", _rename_project(list(RADIOLOGY), RADIOLOGY)),
    CleanerSpec("ehr.surgery", _rename_project(SURGERY_ORDER, SURGERY), destination="ehr.surgeries"),
    CleanerSpec("ehr.vitals", vitals_step, destination="ehr.flowsheet"),
]}
