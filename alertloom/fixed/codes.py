"""Code maps, risk maps, keyword rules, table and field lists."""

# --- fixed values: coded fields of an adverse-event report -------------------
UNKNOWN = "Unknown"

QUALIFICATION = {
    "1": "Physician",
    "2": "Pharmacist",
    "3": "Other Health Professional",
    "4": "Lawyer",
    "5": "Consumer or Non-Health Professional",
}
OUTCOME = {
    "1": "Recovered/Resolved",
    "2": "Recovering/Resolving",
    "3": "Not Recovered/Not Resolved",
    "4": "Recovered/Resolved with Sequelae",
    "5": "Fatal",
    "6": "Unknown",
}
REPORT_TYPE = {
    "1": "Spontaneous",
    "2": "Report from study",
    "3": "Other",
    "4": "Not available to sender",
}
ACTION_DRUG = {
    "1": "Drug withdrawn",
    "2": "Dose reduced",
    "3": "Dose increased",
    "4": "Dose not changed",
    "5": "Unknown",
    "6": "Not applicable",
}
DRUG_CHARACTERIZATION = {"1": "Suspect", "2": "Concomitant", "3": "Interacting"}
SEX = {"1": "Male", "2": "Female"}

CODE_MAPS = {
    "qualification": QUALIFICATION,
    "outcome": OUTCOME,
    "reporttype": REPORT_TYPE,
    "actiondrug": ACTION_DRUG,
    "drugcharacterization": DRUG_CHARACTERIZATION,
}

# --- fixed values: risk ------------------------------------------------------
RECALL_CLASS_RISK = {"I": "Critical", "II": "High", "III": "Medium"}
DEFAULT_RECALL_CLASS = "II"
DEFAULT_RISK = "Medium"

# --- fixed values: document class by file name, first rule that hits wins ----
DOCUMENT_RULES = (
    (("protocol", "sop"), "CLINICAL_PROTOCOL"),
    (("memo", "training"), "TRAINING_MATERIAL"),
    (("manual", "device"), "DEVICE_MANUAL"),
    (("guideline", "guidance"), "CLINICAL_GUIDELINE"),
)
DOCUMENT_DEFAULT = "GENERAL_CLINICAL"
MANIFEST_STATUS = "UPLOADED"
MANIFEST_NO_FORMAT = "UNKNOWN"
MANIFEST_PREFIX = "hospital_documents"

# --- fixed values: tables the analysis needs ---------------------------------
REQUIRED_TABLES = (
    "ground_truth_master",
    "fda_safety_communications",
    "fda_drug_alerts",
    "fda_public_statements",
    "fda_adverse_events",
    "fda_recalls",
)

# --- fixed values: flattened adverse-event columns, in file order ------------
EVENT_FIELDS = (
    "safetyreportid",
    "receivedate",
    "serious",
    "reporttype",
    "fulfillexpeditecriteria",
    "occurcountry",
    "reporter_qualification",
    "patientonsetage",
    "patientsex",
    "medicinalproduct",
    "brand_name",
    "manufacturer_name",
    "drugcharacterization",
    "action_taken_with_drug",
    "drugindication",
    "drugdosagetext",
    "reactions",
    "reaction_outcomes",
)

# --- fixed values: canonical record fields, in file order --------------------
RECORD_FIELDS = (
    "drug_name",
    "device_name",
    "condition",
    "old_dosage",
    "new_dosage",
    "old_warning",
    "new_warning",
    "old_indication",
    "new_indication",
    "recall_reason",
    "risk_level",
    "fda_approval_date",
    "update_date",
    "source_url",
    "ndc_code",
    "clinical_trial_id",
    "patient_population",
    "contraindications",
    "adverse_events",
    "mechanism_of_action",
    "therapeutic_class",
    "manufacturer",
    "regulatory_status",
    "clinical_significance",
    "patient_safety_impact",
    "compliance_deadline",
    "adverse_event_count",
    "recall_class",
    "trial_phase",
    "study_status",
)
RECORD_DATE_FIELDS = ("fda_approval_date", "update_date", "compliance_deadline")
