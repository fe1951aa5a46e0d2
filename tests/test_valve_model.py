"""The valve parser against findings written by hand, and against sets of terms on generated reports."""

from hypothesis import given, settings
from hypothesis import strategies as st

from harmonia import lookups as L
from harmonia.operators import derived

BY_HAND = [
    ("Severe aortic stenosis.", "aortic_stenosis=severe"),
    ("Mild-to moderate mitral regurgitation. Normal LV", "mitral_regurgitation=moderate"),
    ("mild aortic and mitral regurg", "aortic_regurgitation=mild;mitral_regurgitation=mild"),
    ("TAVI valve, trivial aortic regurgitation", "aortic_tavr_regurgitation=trivial"),
    ("mild aortic stenosis. severe aortic stenosis", "aortic_stenosis=severe"),
    ("severe aortic stenosis¤mild pulmonic stenosis§flail tricuspid, severe",
     "aortic_stenosis=severe;pulmonary_stenosis=mild;tricuspid_prolapse=severe"),
    ("aortic stenosis", ""), ("severe stenosis", ""), ("severe aortic", ""), ("", ""), (None, ""),
]


def parsed(spark, reports):
    df = spark.createDataFrame(list(enumerate(reports)), "study_id int, finaldxcollated string")
    return {r["study_id"]: r["valve_findings"] for r in derived.valve_map_text(df, keep=("study_id",)).collect()}


def test_reports_by_hand(spark):
    got = parsed(spark, [r for r, _ in BY_HAND])
    assert [got[i] for i in range(len(BY_HAND))] == [f for _, f in BY_HAND]


TERMS = {group: dict(labels) for group, _, labels in L.valve_groups()}
statement = st.fixed_dictionaries({g: st.lists(st.sampled_from(sorted(labels)), max_size=2, unique=True) for g, labels in TERMS.items()})


def spoken(s):
    """A statement that uses the first keyword of every term in it."""
    return " / ".join(TERMS[g][label][0] for g, labels in s.items() for label in labels)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(statement, max_size=4), min_size=100, max_size=100))
def test_findings_are_the_terms_spoken(spark, reports):
    got = parsed(spark, [". ".join(map(spoken, r)) for r in reports])
    for i, r in enumerate(reports):
        want = {}
        for s in r:
            # of several valve types, lesions or severities, the first in the vocabulary's order counts
            first = {g: next((label for label in TERMS[g] if label in s[g]), None) for g in TERMS}
            if first["lesion"] and first["severity"]:
                for anatomy in s["anatomy"]:
                    want["_".join(filter(None, (anatomy, first["valve_type"], first["lesion"])))] = first["severity"]
        assert got[i] == ";".join(f"{k}={v}" for k, v in sorted(want.items())), r
