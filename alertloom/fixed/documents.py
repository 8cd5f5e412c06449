"""Document templates.

``{name}`` placeholders are filled from columns. The defaults apply only where
a field is null; a blank field stays blank.
"""

# --- fixed values: template, title, file format, content type ----------------
TEMPLATES = {
    "medication_protocol": (
        "Medication Administration Protocol: {subject}", "pdf", "clinical_protocol",
    ),
    "device_manual": ("Operating Manual: {subject}", "pdf", "device_manual"),
    "clinical_guideline": (
        "Clinical Practice Guideline: Management of {subject}",
        "pdf",
        "clinical_guideline",
    ),
    "formulary_entry": ("Hospital Formulary Entry: {subject}", "pdf", "formulary"),
    "training_memo": (
        "Clinical Training Update: {subject}", "txt", "training_material",
    ),
    "safety_alert": (
        "Patient Safety Alert: {subject}", "txt", "safety_communication",
    ),
    "research_summary": (
        "Clinical Research Summary: {subject}", "txt", "research_document",
    ),
    "nursing_protocol": (
        "Nursing Care Protocol: {subject}", "pdf", "nursing_protocol",
    ),
}
IMAGES = "images"
IMAGE_TEMPLATE = "screenshot"
IMAGE_FORMAT = "jpg"
IMAGE_SHARE = 0.2

# --- fixed values: routing choices -------------------------------------------
DEVICE_TEMPLATE = "device_manual"
DRUG_TEMPLATES = ("medication_protocol", "formulary_entry", "training_memo")
CONDITION_TEMPLATES = ("clinical_guideline", "nursing_protocol", "research_summary")
OTHER_TEMPLATES = ("safety_alert", "training_memo")

# --- fixed values: file names and ages ---------------------------------------
FILE_NAME_CHARS = 15
FILE_NAME_DEFAULT = "clinical"
MIN_AGE_DAYS = 30
DAYS_PER_YEAR = 365
DOCUMENT_NUMBER = (1000, 9999)

# --- fixed values: training memo ---------------------------------------------
MEMO_SUBJECT_DEFAULT = "Clinical Update"
MEMO_AGE_DAYS = (90, 365)
MEMO_DOSAGE_LINE = "• Current dosing guidelines: {old_dosage}\n"
MEMO_WARNING_LINE = "• Monitoring requirements: {old_warning}\n"
MEMO_INDICATION_LINE = "• Indications for use: {old_indication}\n"
MEMO_DEFAULTS = {
    "old_warning": "established clinical guidelines",
    "patient_population": "Adult patients",
    "risk_level": "Standard",
    "contraindications": "Standard contraindications apply",
    "adverse_events": "Standard adverse event monitoring protocols apply",
    "mechanism_of_action": "Standard mechanism as previously described",
    "therapeutic_class": "As previously classified",
    "compliance_deadline": "end of month",
}
MEMO = """{title}
{underline}

TO: All Clinical Staff
FROM: Medical Education Department
DATE: {today}
SUBJECT: Important Clinical Update - {subject}

BACKGROUND:
This memo provides important updates regarding {subject} that affect current
clinical protocols and patient care procedures.

CURRENT PROTOCOLS:
{dosage_line}{warning_line}{indication_line}
CLINICAL CONSIDERATIONS:
Staff should be aware that current protocols for {subject} are based on
{old_warning}. 

Patient population affected: {patient_population}
Risk level: {risk_level}
Contraindications: {contraindications}

ADVERSE EVENTS TO MONITOR:
{adverse_events}

MECHANISM OF ACTION:
{mechanism_of_action}

THERAPEUTIC CLASS:
{therapeutic_class}

COMPLIANCE REQUIREMENTS:
All staff must review and acknowledge this update by {compliance_deadline}.

QUESTIONS:
Contact the Medical Education Department with any questions or concerns
regarding these clinical updates.

---
Medical Education Department
Internal Distribution Only
Document ID: MED-{number}
Revision Date: {revised}
"""

# --- fixed values: safety alert ----------------------------------------------
ALERT_SUBJECT_DEFAULT = "Clinical Safety Issue"
ALERT_AGE_DAYS = (30, 180)
ALERT_RECALL_ISSUE = "DEVICE RECALL: {recall_reason}\n"
ALERT_WARNING_ISSUE = (
    "SAFETY WARNING: New safety information has been identified.\n"
)
ALERT_OTHER_ISSUE = (
    "Clinical safety concern identified requiring immediate attention.\n"
)
ALERT_DEFAULTS = {
    "risk_level": "High",
    "manufacturer": "Various manufacturers",
    "old_dosage": "Current dosing protocols",
    "old_warning": "Current monitoring protocols",
    "old_indication": "Current indications",
    "patient_safety_impact": "Potential safety impact requires immediate review",
    "clinical_significance": "Significant clinical implications",
    "patient_population": "All patients receiving this therapy",
    "contraindications": "Review all contraindications",
    "adverse_events": "Any unexpected adverse events",
    "compliance_deadline": "Immediately",
    "regulatory_status": "Under review by regulatory authorities",
}
ALERT = """{title}
{underline}

URGENT PATIENT SAFETY ALERT
Alert Level: {risk_level}
Date Issued: {today}
Alert ID: PSA-{number}

AFFECTED ITEM: {subject}
MANUFACTURER: {manufacturer}

ISSUE DESCRIPTION:
{issue}
CURRENT PROTOCOLS AFFECTED:
• Dosing: {old_dosage}
• Monitoring: {old_warning}
• Indications: {old_indication}

PATIENT SAFETY IMPACT:
{patient_safety_impact}

CLINICAL SIGNIFICANCE:
{clinical_significance}

IMMEDIATE ACTIONS REQUIRED:
1. Review all patients currently receiving {subject}
2. Assess need for therapy modification
3. Implement enhanced monitoring protocols
4. Document all clinical decisions

PATIENT POPULATIONS AT RISK:
{patient_population}

CONTRAINDICATIONS:
{contraindications}

ADVERSE EVENTS:
Monitor closely for: {adverse_events}

COMPLIANCE DEADLINE:
All clinical areas must implement these changes by: {compliance_deadline}

REGULATORY STATUS:
{regulatory_status}

CONTACT INFORMATION:
For questions contact:
• Pharmacy: ext. 1234
• Risk Management: ext. 5678
• Medical Staff Office: ext. 9012

---
Patient Safety Department
Distribution: All Clinical Staff
This alert supersedes previous guidance dated {revised}
"""

# --- fixed values: research summary ------------------------------------------
SUMMARY_SUBJECT_DEFAULT = "Clinical Research"
SUMMARY_AGE_DAYS = (60, 300)
SUMMARY_REVIEW_DAYS = 365
SUMMARY_TRIAL_LINE = (
    "• Clinical trial {clinical_trial_id} provides supporting evidence\n"
)
SUMMARY_DEFAULTS = {
    "mechanism_of_action": "As currently understood",
    "therapeutic_class": "Standard classification",
    "patient_population": "Study populations",
    "old_dosage": "Standard dosing approaches",
    "old_warning": "Established monitoring protocols",
    "old_indication": "Current approved indications",
    "contraindications": "Standard contraindications",
    "adverse_events": "Expected adverse event profile",
    "risk_level": "Standard risk assessment",
    "regulatory_status": "Approved for indicated uses",
    "fda_approval_date": "Historical approval",
}
SUMMARY = """{title}
{underline}

CLINICAL RESEARCH SUMMARY
Research Topic: {subject}
Date Compiled: {today}
Summary ID: CRS-{number}

BACKGROUND:
This summary provides an overview of current research evidence regarding
{subject} and its implications for clinical practice.

CURRENT EVIDENCE BASE:
Based on available clinical trial data and observational studies, current
evidence supports the use of established treatment protocols.

KEY FINDINGS:
{trial_line}• Mechanism of action: {mechanism_of_action}
• Therapeutic class: {therapeutic_class}
• Patient population: {patient_population}

CLINICAL IMPLICATIONS:
Current protocols recommend:
• Dosing: {old_dosage}
• Monitoring: {old_warning}
• Indications: {old_indication}

SAFETY PROFILE:
Contraindications: {contraindications}
Adverse events: {adverse_events}
Risk level: {risk_level}

REGULATORY STATUS:
FDA Status: {regulatory_status}
Approval Date: {fda_approval_date}

CLINICAL PRACTICE RECOMMENDATIONS:
Based on current evidence, clinicians should follow established protocols
for {subject}. Regular monitoring and assessment are recommended
according to current guidelines.

FUTURE RESEARCH DIRECTIONS:
Additional studies may provide further insights into optimal therapeutic
approaches and patient selection criteria.

REFERENCES:
• Clinical trials database (ClinicalTrials.gov)
• FDA guidance documents
• Professional society guidelines
• Peer-reviewed medical literature

---
Clinical Research Department
For internal use only
Last updated: {revised}
Next review date: {next_review}
"""

# --- fixed values: documents laid out on pages, as their text -----------------
# Of each slot: the field and what stands there if the field is null, or the options.
PAGE_AGE_DAYS = {
    "medication_protocol": (180, 730),
    "formulary_entry": (180, 730),
    "clinical_guideline": (365, 1095),
    "device_manual": (180, 730),
    "nursing_protocol": (180, 730),
}
PROTOCOL_SUBJECT_DEFAULT = "Medication"
PROTOCOL_FIELDS = {
    "review_date": ("compliance_deadline", ""),
    "therapeutic_class": ("therapeutic_class", "Not specified"),
    "risk_level": ("risk_level", "Medium"),
    "old_dosage": ("old_dosage", "Standard dosing as per manufacturer guidelines"),
    "old_warning": ("old_warning", "Standard monitoring protocols apply"),
    "patient_population": ("patient_population", "Adult patients 18+ years"),
    "contraindications": ("contraindications", "Standard contraindications apply"),
    "adverse_events": ("adverse_events", "Monitor for standard adverse effects"),
    "mechanism_of_action": ("mechanism_of_action", "complex pharmacological pathways"),
    "condition": ("condition", "appropriate patient populations"),
}
PROTOCOL_CHOICES = {
    "route": ("Oral", "IV", "IM", "Subcutaneous"),
    "frequency": ("Once daily", "Twice daily", "Three times daily", "As needed"),
    "duration": ("7 days", "14 days", "30 days", "Until discontinued"),
}
PROTOCOL = """{title}
{underline}

Document Control Information
Document ID: MED-PROT-{number}
Effective Date: {approved}
Review Date: {review_date}
Therapeutic Class: {therapeutic_class}
Risk Level: {risk_level}

Standard Dosing Protocol
Current Standard Dose: {old_dosage}
Monitoring Requirements: {old_warning}

Administration Guidelines
Route of Administration: {route}
Frequency: {frequency}
Duration: {duration}
Patient Population: {patient_population}

Contraindications and Precautions
Contraindications: {contraindications}
Adverse Events: {adverse_events}

Detailed Clinical Considerations

Patient Monitoring Protocol
Regular monitoring is essential for safe administration of {subject}.
Current protocols require {old_warning}. Healthcare providers should assess
patient response and adjust therapy accordingly. Baseline laboratory values
should be obtained prior to initiation.
The mechanism of action involves {mechanism_of_action}.
Clinical efficacy has been demonstrated in {condition}.

Special Populations
Elderly Patients: Dose adjustment may be required based on renal function and overall health status.
Pediatric Patients: Safety and efficacy not established in patients under 18 years.
Pregnancy: Use only if potential benefit justifies potential risk to fetus.
Nursing Mothers: Exercise caution when administering to nursing women.

Last revised: {revised}
"""
MANUAL_SUBJECT_DEFAULT = "Medical Device"
MANUAL_FIELDS = {
    "manufacturer": ("manufacturer", "Medical Device Corp"),
    "regulatory_status": ("regulatory_status", "FDA Cleared"),
    "old_warning": ("old_warning", "Standard operating procedures apply"),
    "old_indication": ("old_indication", "As indicated in original labeling"),
    "contraindications": ("contraindications", "Standard contraindications apply"),
    "risk_level": ("risk_level", "None"),
}
MANUAL_CHOICES = {
    "major": ("1", "2", "3", "4", "5"),
    "minor": ("0", "1", "2", "3", "4", "5", "6", "7", "8", "9"),
    "calibration": ("Daily", "Weekly", "Monthly", "Quarterly"),
    "maintenance": ("Monthly", "Quarterly", "Semi-annually", "Annually"),
}
MANUAL_RECALL = """
IMPORTANT SAFETY NOTICE
RECALL NOTICE: This device has been subject to a recall.
Reason: {recall_reason}
Risk Level: {risk_level}
Please discontinue use immediately and contact the manufacturer.
"""
MANUAL = """{title}
{underline}

Device Information
Model Number: MDL-{number}
Manufacturer: {manufacturer}
FDA Status: {regulatory_status}
Classification: Class II Medical Device
Manual Version: v{major}.{minor}

Operating Instructions
Current Operating Protocol: {old_warning}

Safety Information
WARNING: This device should only be operated by trained medical personnel.
Failure to follow proper procedures may result in patient harm or device malfunction.
Indications for Use: {old_indication}
Contraindications: {contraindications}
{recall}
Maintenance and Calibration
Regular maintenance is essential for proper device function. Follow manufacturer
guidelines for calibration and preventive maintenance. Inspect device daily
for signs of wear or damage.
Calibration Schedule: {calibration}
Preventive Maintenance: {maintenance}
"""
GUIDELINE_SUBJECT_DEFAULT = "Medical Condition"
GUIDELINE_FIELDS = {
    "patient_population": ("patient_population", "Adult patients"),
    "old_dosage": ("old_dosage", "As per manufacturer guidelines"),
    "monitoring": ("old_warning", "Standard monitoring applies"),
    "intervals": ("old_warning", "standard monitoring intervals"),
    "old_indication": ("old_indication", "standard therapeutic approaches"),
    "contraindications": ("contraindications", "standard contraindications"),
    "adverse_events": ("adverse_events", "expected adverse effects"),
}
GUIDELINE_CHOICES = {"grade": ("Grade A", "Grade B", "Grade C")}
GUIDELINE_DRUG = """First-line Therapy: {drug_name}
Recommended Dosing: {old_dosage}
Monitoring: {monitoring}
"""
GUIDELINE = """{title}
{underline}

Clinical Practice Guideline
Condition: {subject}
Target Population: {patient_population}
Evidence Level: {grade}
Last Updated: {revised}

Treatment Recommendations
{therapy}
Clinical Evidence Summary
Current evidence supports the use of established treatment protocols for {subject}.
Clinical trials have demonstrated efficacy with {old_indication}.
Contraindications include {contraindications}.
Clinicians should monitor for {adverse_events}.

Detailed Clinical Management

Diagnostic Criteria
Diagnosis of {subject} should be based on clinical presentation, laboratory findings,
and imaging studies as appropriate. Consider differential diagnoses and comorbid conditions.
Key diagnostic features include:
• Clinical symptoms consistent with {subject}
• Laboratory abnormalities as expected
• Imaging findings supportive of diagnosis
• Response to therapeutic interventions

Therapeutic Monitoring
Ongoing monitoring is essential for optimal patient outcomes. Current protocols
recommend {intervals}.
Patients should be assessed regularly for:
• Treatment efficacy
• Adverse effects
• Disease progression
• Need for therapy modification
"""
NURSING_SUBJECT_DEFAULT = "Patient Care"
NURSING_FIELDS = {
    "review_date": ("compliance_deadline", ""),
    "risk_level": ("risk_level", "Medium"),
    "care_level": ("risk_level", "Standard"),
    "patient_population": ("patient_population", "Adult patients"),
    "old_dosage": ("old_dosage", "As ordered by physician"),
    "condition": ("condition", "As diagnosed"),
    "old_warning": ("old_warning", "Standard monitoring protocols"),
    "contraindications": ("contraindications", "Standard contraindications"),
    "adverse_events": ("adverse_events", "Standard adverse events"),
}
NURSING_CHOICES = {
    "route": ("PO", "IV", "IM", "SQ"),
    "frequency": ("QD", "BID", "TID", "QID", "PRN"),
    "assessment": ("Q4H", "Q8H", "Q12H", "Daily", "PRN"),
}
NURSING_DRUG = """Medication Administration:
• Drug: {drug_name}
• Dosage: {old_dosage}
• Route: {route}
• Frequency: {frequency}
"""
NURSING_CARE = """Patient Care Protocol:
• Condition: {condition}
• Care level: {care_level}
"""
NURSING = """{title}
{underline}

Nursing Protocol Information
Protocol ID: NP-{number}
Effective Date: {updated}
Review Date: {review_date}
Risk Level: {risk_level}
Patient Population: {patient_population}

Care Instructions
{care}
Monitoring and Assessment
Required Monitoring: {old_warning}
Assessment Frequency: {assessment}
Vital Signs: Monitor per unit protocol
Laboratory: As ordered by physician

Safety Considerations
Contraindications: {contraindications}
Adverse Events to Monitor: {adverse_events}
Emergency Actions: Follow unit emergency protocols
"""
