"""Vocabularies and lookup tables.

Everything between the FIXED VALUES markers must equal the values the original pipeline ships,
because results depend on them (segment names, keyword lists, recodes, patterns).  They are kept
as plain text in their natural order.  Everything after the markers is our own (synthetic
diagnosis code sets, the test secret).

Lookups are small and of fixed size; they are turned into DataFrames only to be broadcast into
joins (see ``lookup_df``), never collected from data.
"""

from __future__ import annotations

# ----------------------------------------------------------------------------------------------
# FIXED VALUES (must equal the reference behaviour)
# ----------------------------------------------------------------------------------------------

# Coronary lesion vocabulary: segment -> lesion codes written in the lesion column.
# Matching is exact, so trailing blanks are part of a code.
LESION_SEGMENTS: dict[str, list[str]] = {
    "LM": ["oLM", "pLM", "mLM", "dLM", "dLM-PLAD", "dLM "],
    "Proximal LAD": ["pLAD", "pLAD ", "oLAD", "dLM-PLAD", "p-mLAD"],
    "Mid LAD": ["mLAD", "p-mLAD"],
    "Distal LAD": ["dLAD"],
    "D1": ["D1"],
    "D2": ["D2", "D3"],
    "Proximal LCX": ["pCX", "pCx", "oCX", "oCx", "oLCX", "oLCx", "lCx"],
    "Mid LCX": ["mCX", "mCx", "mLCX"],
    "Distal LCX": ["dCX", "dCx"],
    "LPDA": ["LPDA", "ostial LPDA", "prox-mid LPDA", "LPDA "],
    "LPL": ["LPL", "LPL1", "LPL2"],
    "OM1": ["OM1", "OM"],
    "OM2": ["OM2", "oOM2 ", "OM3", "OM4"],
    "Proximal RCA": ["pRCA", "oRCA"],
    "Mid RCA": ["mRCA"],
    "Distal RCA": ["dRCA"],
    "RPDA": ["RPDA", "oRPDA"],
    "RPL": ["RPL1", "RPL", "RPL2", "RPL3"],
    "Ramus Intermedius": ["RI", "RI ", "RI Cx"],
    "Graft to LAD": ["LIMA LAD", "LIMA", "SVG LAD", "SVG D1 seq", "SVG D1"],
    "Graft to LCX": ["SVG OM", "SVG OM1", "SVG OM2", "SVG RI"],
    "Graft to RCA": ["SVG RCA", "SVG RPDA", "SVG RPL"],
}

# Echo report vocabulary.  Groups are walked in this order for every statement.
# "exclusive": the first label with a keyword found in the statement wins, none found resets
# the key to empty; "nonexclusive": every label with a keyword found is appended.
# Keywords are plain substrings.  The shipped list glues two pairs of keywords together
# ("corevalv" + "tavi" and "pulmonary" + "pulmonic") through missing commas; VALVE_GROUPS_SHIPPED
# keeps that spelling, VALVE_GROUPS (the default) separates them.
VALVE_STATEMENT_SEPARATORS = ["§", "¤", ". "]
VALVE_GROUPS: list[tuple[str, str, list[tuple[str, list[str]]]]] = [
    ("valve_type", "exclusive", [
        ("mechanical", ["on x", "tilting", "starr edward", "st jude", "bileaflet", "mechanical"]),
        ("bioprosthetic", ["bioprosthesis"]),
        ("tavr", ["sapien", "evolut", "corevalv", "tavi", "tavr"]),
        ("mitraclip", ["mitraclip"]),
        ("triclip", ["triclip"]),
    ]),
    ("anatomy", "nonexclusive", [
        ("aortic", ["aortic"]),
        ("mitral", ["mitral"]),
        ("tricuspid", ["tricuspid"]),
        ("pulmonary", ["pulmonary", "pulmonic"]),
    ]),
    ("lesion", "exclusive", [
        ("stenosis", ["stenosis"]),
        ("regurgitation", ["regurg"]),
        ("prolapse", ["prolapse", "vp", "flail"]),
        ("bicuspid_valve", ["bicuspid", "bav", "opening line"]),
        ("annular_calcification", ["annular calcification"]),
        ("systolic_anterior_motion", ["sam", "systolic anterior motion"]),
        ("vegetation", ["vegetation"]),
        ("mass", ["mass"]),
    ]),
    ("severity", "exclusive", [
        ("severe", ["severe"]),
        ("moderate", ["mod", "moderate"]),
        ("mild", ["mild"]),
        ("trivial", ["trivial"]),
    ]),
]
VALVE_KEYWORD_OVERRIDES_SHIPPED = {
    "tavr": ["sapien", "evolut", "corevalvtavi", "tavr"],
    "pulmonary": ["pulmonarypulmonic"],
}

# Recodes (value -> replacement; None means "becomes null"; unmapped values pass through).
GENDER_RECODE = {"1": None, "2": None, "F": "Female", "M": "Male", "U": "Unknown"}
ETHNICITY_RECODE = {
    "C": "Chinese", "CA": "Caucasian", "CN": "Chinese", "EU": "Eurasian", "I": "Indian",
    "IN": "Indian", "M": "Malay", "MY": "Malay", "N": None, "O": "Others", "S": "Sikh",
    "SK": "Sikh", "XX": "Unknown",
}
ROUTE_RECODE = {"PO": "Oral", "IV": "Intravenous", "SC": "Subcutaneous", "NG": "Nasogastric",
                "IM": "Intramuscular"}
# Outpatient duration: cycle ranges count as one unit; units convert to days.
CYCLE_RANGES = ["d2-d6", "d1-d12", "d15-d25", "d1-d15", "d1-d14"]
DURATION_UNIT_DAYS = {
    "months": 30, "month": 30, "menstrual cycle": 30, "calendar month": 30, "mens cycle": 30,
    "days per cycle": 30, "weeks": 7, "week": 7, "days": 1, "day": 1,
}

# Encounter / medication class: first rule whose any substring occurs (case-sensitive) wins.
MEDICATION_CLASS_RULES = [
    (["IP", "Inpatient"], "Inpatient"),
    (["discharge", "Discharge"], "Discharge"),
    (["AE", "Emergency"], "Emergency"),
    (["DS"], "Day Surgery"),
    (["OP", "Outpatient"], "Outpatient"),
]

DEATH_OUTCOMES = ["Death Coroners", "Death Non-Coroners", "Deceased"]

# Whole-cell national id pattern (one or two letters, seven digits, optional letter).
NATIONAL_ID_PATTERN = r"^[a-zA-Z]{1,2}[0-9]{7}[a-zA-Z]?$"
REDACTED = "[REDACTED]"

# Free-text medication instruction patterns (case-insensitive, first match).
INSTRUCTION_VERBS = (r"(Take|Inject|Infuse|Apply|Insert|Chew|Place|Swallow|Spray|Drink|Put|Give|"
                     r"Administer|Inhale)?")
INSTRUCTION_DOSE_UNITS = (
    r"(mg|g|mL|L|litre(s)?|UNIT|units|mcg|µg|IU|drop(s)?|application(s)?|tablet(s)?|capsule(s)?|"
    r"scoop(s)?|feed(s)?|sachet(s)?|lozenge(s)?|puff(s)?|plaster(s)?|patch(es)?|suppositor(y|ies)?|"
    r"each|dose|spray(s)?|inhalation(s)?)"
)
INSTRUCTION_DOSE = INSTRUCTION_VERBS + r"\s*([\d,\.]+\s*" + INSTRUCTION_DOSE_UNITS + ")"
INSTRUCTION_FREQUENCY = (
    r"(every\s+(other\s+)?(hour|morning|night|day|\d+\s*(hours?|days?|weeks?)|"
    r"Mon|Tue|Wed|Thu|Fri|Sat|Sun)|"
    r"once\s+(only|a\s+day|daily)?|twice\s+(a\s+day|daily)?|"
    r"\d+\s+times\s+a\s+(day|week)|"
    r"\d+\s+feeds\s+a\s+day|"
    r"at\s+bedtime|"
    r"when required|as needed|prn|"
    r"(before\s+(meals?|dialysis|procedure))|"
    r"on\s+non-dialysis\s+days|"
    r"\([^)]+\)\s*(OM|ON)|OM|ON|PM|OD|BD|TDS|QDS|QID|"
    r"(once\s+only\s+on\s+\d{1,2}\s+\w+))"
)
INSTRUCTION_DURATION = r"(for\s+(up\s+to\s+)?\d+\s+(days?|weeks?)|once\s+for\s+\d+\s+dose)"
TOPICAL_PHRASE = "apply to affected area"
TOPICAL_DOSE = "topical (unspecified)"

# CIS common step.
CIS_DROP_COLUMNS = ["RF_IDRef", "NEXUSIDRef", "VIP", "Original Study Num", "ResCode"]
CIS_HOSPITAL_ALIASES = ["HospitalID", "Proc_HospitalID", "Procedure_Hospital"]
CIS_DATE_SENTINEL = "00/00/00"
CIS_RENAMES = {"IDRef": "subject_id", "Study Num": "study_id", "Procedure Date": "procedure_date",
               "Procedure2": "procedure_name", "Hospital": "hospital"}

# Column-name length limit of the target database.
MAX_COLUMN_NAME = 59

# Raw file name -> canonical table.
RAW_TABLE_ALIASES = {
    "NTF_AH_Procedure": "cis.procedure", "NTF_AH_PTCA": "cis.pci", "Coros_NUH": "cis.cag",
    "COROS_Lesion": "cis.caglesion", "ECHO_NUH": "cis.echo", "NTF_AH_Nuclear": "cis.nuclear",
    "ecg_index": "ecg.muse", "Procedure_NUH": "cis.procedure", "metadata_iecg": "ecg.iecg",
    "NTF_AH_PTCA_export_sequence_timings": "cis.pcidevicesequencetimings",
    "ccd_cardiacsurgery": "ccd.cardiacsurgery", "NTF_AH_Pacemaker": "cis.pacemaker",
    "NTF_AH_Coros": "cis.cag", "NTF_AH_PTCA_export_sequence": "cis.pcidevicesequence",
    "ehr_combined_encounter": "ehr.encounter", "NTF_AH_PTCA_export": "cis.pcilesionsequence",
    "nuclear_NUH": "cis.nuclear", "ccd_coronaryphysiology": "ccd.coronaryphysiology",
    "NTF_AH_Coros_Lesion": "cis.caglesion", "NTF_AH_ECHO": "cis.echo", "PTCA_NUH": "cis.pci",
    "dts_laboratory": "ehr.dts_laboratory", "ehr_edw_labs": "ehr.edw_laboratory",
    "dts_discharge_medication": "ehr.dts_discharge_medication",
    "dts_medication": "ehr.dts_medication", "ehr_edw_medication": "ehr.edw_medication",
    "ehr_edw_outpatient_medication": "ehr.edw_outpatient_medication", "patient": "ehr.patient",
    "ohca_nuh_deid_fixed": "ccd.ohca", "ehr_diagnosis_codes": "concept.diagnosis_codes",
    "ehr_problem_list": "ehr.problem_list", "dts_radiology": "ehr.radiology",
    "flowsheet_vital_signs": "ehr.vitals", "dts_surgeries": "ehr.surgery",
}

# Identifying columns dropped per canonical table (None: nothing to drop).
PHI_COLUMNS = {
    "cis.cag": ["Comments", "Case Closed Date", "HTML", "ScrubNurse1", "ScrubNurse2", "Radiographer"],
    "cis.caglesion": None,
    "cis.caglesionpivoted": None,
    "cis.echo": ["Case Closed Date", "Test Report", "OriginalStudyNum", "RF_IDRef", "UniqueID",
                 "StaffNurse"],
    "cis.nuclear": ["Proc_HospitalID", "ResCode", "StudyID", "Most_recent_MI", "Date_of_last_PTCA",
                    "Date_of_last_CABG", "Previous_Nuclear_Study_Date",
                    "Previous_Nuclear_Study_Done_in", "Case Closed Date", "TempStudyNo", "HTML",
                    "RF_IDRef", "UniqueID", "Radiographer", "StaffNurse"],
    "cis.pacemaker": ["Proc_HospitalID", "ResCode", "Original Study Num", "Case Closed Date",
                      "Serial No", "Comments", "Explant_Serial Number", "HTML", "id_Study",
                      "UniqueID", "Past_PrevCABGProcDate", "Past_PrevPTCAProcDate",
                      "Procedure_Date", "Procedure_Hospital", "ProcedureStartTime",
                      "ProcedureEndTime", "Radiographer", "ScrubNurse", "CirculatingNurse"],
    "cis.pci": ["Proc_HospitalID", "ResCode", "Original Study Num", "PTCA_ID", "Admission_Date",
                "Discharge_Date", "Staff_Nurse", "Radiographer", "IIBIIIA_Date", "Hospital",
                "Case Closed Date", "Anaesthetist", "Sonographer3", "Surgeon1", "Surgeon2",
                "Echocardiologist", "RF_IDRef", "UniqueID", "Circulating_Nurse", "OctID"],
    "cis.pcidevicesequence": ["PTCA_Export_ID", "Combined_Serial", "UniqueID"],
    "cis.pcidevicesequencetimings": ["PTCA_Export_Sequence_ID", "Proc_HospitalID", "PTCA_ID",
                                     "Start_Date", "PTCA_Export_ID"],
    "cis.pcilesionsequence": ["PTCA_ID", "Serial_No", "Serial2", "Combined_Serial",
                              "PTCA_Export_ID", "UniqueID"],
    "cis.procedure": ["Referring Dr", "Supervising Dr", "Sonographer", "Tape Code", "Tape Number1",
                      "Case Closed Date", "Original Study Num", "Supervising Dr2", "Sonographer2",
                      "Tape Number2", "RoomNo", "Counter1", "Counter2", "Age", "ProcTimeIn",
                      "ProcTimeOut", "ProcedureID", "Age_date", "Supervising Dr3",
                      "Supervising Dr4", "AmendedDate", "HospitalID", "ClosedBy", "ReopenBy",
                      "OrganizationalUnitName", "sapRoomNo", "sapBedNo", "sapReferringDr",
                      "sapAdmittingDr", "sapAttendingDr", "sapDischargeDr", "CostCtr_grp",
                      "HTML_ID", "DerivedStudyNumber", "Nurse", "MCR_SupervisingDr",
                      "MCR_SupervisingDr2", "MCR_SupervisingDr3", "MCR_SupervisingDr4",
                      "sapPatientVisitNo", "MCR_sapReferringDr", "MCR_sapAttendingDr",
                      "MCR_ReferringDr", "Proc_CaseNo", "Proc_HospitalID", "MCR_sapAdmittingDr",
                      "MCR_sapDischargeDr", "MovementNo"],
}

# Comorbidity flags carried by the patient table, each followed by its onset column.
COMORBIDITIES = ["hypertension", "hyperlipidemia", "diabetes_mellitus", "ihd", "heart_failure",
                 "stroke", "afib", "chronic_kidney_disease", "renal_replacement_therapy",
                 "peripheral_vascular_disease", "thyroid_disease", "copd"]

# Shared output shapes.
MEDICATION_COLUMNS = ["subject_id", "medication_start_dt", "medication_end_dt", "medication_route",
                      "medication_name", "medication_type", "instruction", "dose", "dose_units",
                      "frequency", "duration", "duration_units"]
LAB_COLUMNS = ["subject_id", "location", "specimen_collected_dt", "report_dt",
               "investigation_item", "numeric_value", "numeric_value_uom", "text_value"]

# ----------------------------------------------------------------------------------------------
# END OF FIXED VALUES
# ----------------------------------------------------------------------------------------------

# Diagnosis code sets per source system.  The original pipeline reads them from a file it does
# not ship, so these are synthetic test values of the same shape {db_source: {category: codes}}.
DIAGNOSIS_CODE_SETS: dict[str, dict[str, list[str]]] = {
    "dts": {
        "hypertension": ["1", "2", "3", "10", "11"],
        "diabetes": ["20", "21", "22"],
        "ihd": ["30", "31", "32", "33"],
        "heart_failure": ["40", "41"],
    },
    "edw": {
        "hypertension": ["5", "6", "7"],
        "diabetes": ["25", "26"],
        "ihd": ["35", "36", "37"],
        "heart_failure": ["45", "46", "47"],
        "afib": ["50", "51", "52", "53"],
    },
}

# Test secret for pseudonyms (a real deployment passes its own).
TEST_SECRET = {"salt": "harmonia-test-salt", "start_idx": 5, "length": 20}


def lesion_lookup_rows() -> list[tuple[str, str, int]]:
    """(code, segment, segment position) for every vocabulary entry, in vocabulary order."""
    return [(code, seg, i) for i, (seg, codes) in enumerate(LESION_SEGMENTS.items()) for code in codes]


def valve_groups(shipped: bool = False) -> list[tuple[str, str, list[tuple[str, list[str]]]]]:
    if not shipped:
        return VALVE_GROUPS
    out = []
    for group, mode, labels in VALVE_GROUPS:
        out.append((group, mode, [(lab, VALVE_KEYWORD_OVERRIDES_SHIPPED.get(lab, kws))
                                  for lab, kws in labels]))
    return out


def valve_key_space(shipped: bool = False) -> list[str]:
    """Every column the valve parser can produce: anatomy[_valvetype]_lesion."""
    groups = {g: labels for g, _, labels in valve_groups(shipped)}
    anatomies = [a for a, _ in groups["anatomy"]]
    vtypes = [None] + [v for v, _ in groups["valve_type"]]
    lesions = [les for les, _ in groups["lesion"]]
    return [f"{a}_{v}_{les}" if v else f"{a}_{les}" for a in anatomies for v in vtypes for les in lesions]


def diagnosis_lookup_rows(code_sets: dict | None = None) -> list[tuple[str, str, str]]:
    code_sets = code_sets or DIAGNOSIS_CODE_SETS
    return [(db, dx, code) for db, cats in code_sets.items() for dx, codes in cats.items()
            for code in codes]


def diagnosis_categories(code_sets: dict | None = None) -> list[str]:
    code_sets = code_sets or DIAGNOSIS_CODE_SETS
    return sorted({dx for cats in code_sets.values() for dx in cats})


def lookup_df(spark, rows, schema: str):
    """A small fixed lookup as a DataFrame (to be broadcast by the caller)."""
    return spark.createDataFrame(rows, schema)
