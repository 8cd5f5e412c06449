"""Flattening and the four normalisers, on invented records."""

from alertloom import schemas
from alertloom.fixed.codes import EVENT_FIELDS, RECORD_FIELDS
from alertloom.operators import flatten, normalize

DAY = "2025-09-14"
BARE = {"safetyreportid": "r0", "patient": {"drug": [], "reaction": None}}
FULL = {
    "safetyreportid": "r1",
    "serious": "2",
    "seriousnessother": "1",
    "reporttype": "1",
    "fulfillexpeditecriteria": "1",
    "primarysource": {"qualification": "2"},
    "patient": {
        "patientonsetage": "44",
        "patientsex": "2",
        "drug": [
            {
                "medicinalproduct": "Invented A",
                "actiondrug": "4",
                "openfda": {"brand_name": ["Brand A", "Brand B"], "manufacturer_name": []},
            },
            {"medicinalproduct": "Invented B"},
        ],
        "reaction": [
            {"reactionmeddrapt": "X", "reactionoutcome": "5"},
            {"reactionmeddrapt": "", "reactionoutcome": None},
            {"reactionmeddrapt": "Y"},
            {"reactionmeddrapt": "Z"},
        ],
    },
}


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_flatten_full_report(spark):
    df = spark.createDataFrame([FULL], schemas.EVENT_REPORT)
    flat = only(flatten.flatten_adverse_events(df))
    assert tuple(flat) == EVENT_FIELDS
    assert flat["reactions"] == "X; ; Y; Z"
    assert flat["reaction_outcomes"] == "Fatal; Unknown; Unknown; Unknown"
    assert (flat["medicinalproduct"], flat["brand_name"]) == ("Invented A", "Brand A")
    assert flat["manufacturer_name"] is None
    assert flat["action_taken_with_drug"] == "Dose not changed"
    assert flat["drugcharacterization"] == "Unknown"
    assert (flat["patientsex"], flat["reporter_qualification"]) == ("Female", "Pharmacist")


def test_flatten_without_drugs_or_reactions(spark):
    df = spark.createDataFrame([BARE], schemas.EVENT_REPORT)
    flat = only(flatten.flatten_adverse_events(df))
    assert flat["drugcharacterization"] is None and flat["action_taken_with_drug"] is None
    assert flat["reactions"] == "" and flat["reaction_outcomes"] == ""
    assert (flat["fulfillexpeditecriteria"], flat["patientsex"]) == ("No", "Unknown")


def test_event_takes_three_reactions_before_dropping_blanks(spark):
    df = spark.createDataFrame([FULL], schemas.EVENT_REPORT)
    record = only(normalize.normalize_events(df, DAY))
    assert tuple(record) == RECORD_FIELDS
    assert record["condition"] == "X, Y" and record["adverse_event_count"] == 2
    assert record["risk_level"] == "High"
    assert record["patient_population"] == "Patients similar to case: 2, age 44"
    assert record["source_url"].endswith("/r1")


def test_event_defaults(spark):
    df = spark.createDataFrame([{"patient": None}], schemas.EVENT_REPORT)
    record = only(normalize.normalize_events(df, DAY))
    assert record["drug_name"] == "Unknown Drug"
    assert record["condition"] == "Adverse drug reaction"
    assert record["source_url"].endswith("/unknown")
    assert record["new_warning"] == "Enhanced monitoring for: "


def test_trial_drops_blank_names_before_taking_three(spark):
    study = {
        "protocolSection": {
            "identificationModule": {"nctId": "NCT7", "briefTitle": None},
            "conditionsModule": {"conditions": ["c" * 90, "second condition"]},
            "armsInterventionsModule": {
                "interventions": [{"name": n} for n in ("a", "", None, "b", "c", "d")]
            },
            "designModule": {"phases": ["P1", "P2"], "enrollmentInfo": None},
        }
    }
    record = only(
        normalize.normalize_trials(spark.createDataFrame([study], schemas.CLINICAL_TRIAL), DAY)
    )
    assert record["drug_name"] == "a, b, c"
    assert len(record["condition"]) == 100
    assert record["new_indication"].endswith("second condition")
    assert record["patient_population"] == "Clinical trial participants (n=0)"
    assert (record["manufacturer"], record["trial_phase"]) == ("Trial Sponsor", "P1, P2")
    assert record["compliance_deadline"] == "2025-12-13"


def test_recall_defaults_and_cut(spark):
    rows = [{"recall_number": None}, {"recall_number": "1", "product_description": "d" * 120}]
    df = spark.createDataFrame(rows, schemas.DEVICE_RECALL)
    bare, long = sorted(
        normalize.normalize_recalls(df, DAY).collect(), key=lambda r: r.source_url
    )
    assert (bare.risk_level, bare.recall_class) == ("High", "II")
    assert bare.new_warning == "RECALL CLASS II: Safety concern"
    assert bare.old_indication == "Medical device use" and bare.update_date == DAY
    assert len(long.device_name) == 100 and len(long.old_indication) == 120


def test_label_overrides_and_filler(spark):
    rows = [("s1", "warfarin", "high_risk_drugs"), ("s2", "aspirin", "cardiac_drugs")]
    df = spark.createDataFrame(rows, "setid STRING, drug_name STRING, category STRING")
    known, other = sorted(
        normalize.normalize_labels(df, DAY).collect(), key=lambda r: r.source_url
    )
    assert known.old_dosage == "5mg daily" and known.therapeutic_class == "High Risk Drugs"
    assert other.old_dosage.endswith("mg daily")
    assert other.old_warning == "Standard monitoring recommended"
    assert other.ndc_code.count("-") == 2
    again = normalize.normalize_labels(df.repartition(3), DAY).collect()
    assert {r.ndc_code for r in again} == {known.ndc_code, other.ndc_code}
