"""Prompts, default answers and impact constants."""

# --- fixed values: the scenario used when no record qualifies ----------------
DEMO_SCENARIO = {
    "clinical_entity": "warfarin",
    "drug_name": "warfarin",
    "device_name": None,
    "condition": None,
    "risk_level": "Critical",
    "old_warning": "Monitor INR monthly",
    "new_warning": (
        "BOXED WARNING: Weekly INR monitoring required for elderly patients"
    ),
    "clinical_significance": (
        "Age-adjusted dosing reduces major bleeding events by 40% in elderly patients"
    ),
    "patient_safety_impact": (
        "Critical - immediate protocol revision required for patient safety"
    ),
    "manufacturer": "Multiple manufacturers",
    "compliance_deadline": "2025-10-15",
}

# --- fixed values: default briefing ------------------------------------------
BRIEFING = """**Clinical Risk Summary**
A new critical patient safety risk has been identified concerning {entity}. The latest guidance indicates a significant adverse event pattern that requires an immediate review of all related clinical protocols to mitigate potential harm.

**Patient Population Impact**
All patients currently receiving treatment involving {entity} are considered at high risk. This is particularly urgent for vulnerable populations within the hospital, whose safety may be compromised under current standard procedures.

**Immediate Safety Concerns**
The primary concern is the potential for severe, preventable adverse events if existing protocols are not updated immediately. The gap between the old and new guidance represents a direct threat to patient safety.

**Implementation Urgency**
Immediate action is required. A full review and update of all clinical documents, workflows, and staff training related to {entity} must be initiated within the next 24 hours to ensure compliance and protect patients.
"""

# --- fixed values: prompts ---------------------------------------------------
BRIEFING_PROMPT = """
    As a clinical risk analyst briefing a busy hospital executive, generate a concise and scannable risk assessment for the following update.
    
    **Input Data:**
    - Entity: {entity}
    - Risk Level: {risk}
    - Previous Guidance: {old_warning}
    - New Guidance: {new_warning}
    - Clinical Significance: {significance}
    
    **Instructions:**
    1.  Create a briefing with four sections: "Clinical Risk Summary," "Patient Population Impact," "Immediate Safety Concerns," and "Implementation Urgency."
    2.  **Crucially, keep each section to a maximum of two or three sentences.**
    3.  Use bullet points for lists to ensure scannability.
    4.  The tone must be direct, professional, and actionable. Do not repeat the input information.
    """
COST_PROMPT = """
    Calculate the estimated total financial liability in USD for a hospital that fails to implement this critical clinical update:
    Clinical Entity: {entity}
    Risk Level: {risk}
    Safety Impact: {impact}
    Clinical Significance: {significance}
    
    Consider these cost factors: potential adverse events, regulatory non-compliance fines, legal liability, and operational disruption.
    Return only a single numeric value representing the total estimated cost in USD.
    """
PLAN_PROMPT = """
    Based on the following clinical risk assessment and financial impact, generate a high-level action plan.
    
    Clinical Briefing: {briefing}
    Estimated Financial Liability: ${cost}
    
    Identify the top 5 most impacted hospital departments. For each department, provide a priority level (IMMEDIATE, URGENT, HIGH), a summary of the key action required, and the estimated hours to implement the initial changes.
    """
NULL_TEXT = "None"

# --- fixed values: generation options and answer fields ----------------------
TEMPERATURE = 0.1
MAX_OUTPUT_TOKENS = 2048
FINISHED = "STOP"
TRUNCATED = "MAX_TOKENS"
PLAN_SCHEMA = (
    "department STRING, priority STRING, key_action STRING, estimated_hours INT64"
)

# --- fixed values: default cost by risk, and how a cost splits ---------------
COST_BY_RISK = {"Critical": 750000, "High": 350000}
COST_OTHERWISE = 125000
COST_SHARES = (
    ("Potential Adverse Events", 60),
    ("Regulatory Compliance", 20),
    ("Operational Disruption", 15),
    ("Legal/Administrative", 5),
)

# --- fixed values: default action plan ---------------------------------------
ACTION_PLAN = (
    ("ICU", "IMMEDIATE", "Update patient monitoring protocols immediately.", 8),
    ("Cardiology", "URGENT", "Revise dosing guidelines for at-risk patients.", 16),
    ("Emergency", "URGENT", "Update triage and admission protocols.", 12),
    ("Pharmacy", "HIGH", "Update automated dispensing cabinet warnings.", 24),
    (
        "Nursing Education",
        "HIGH",
        "Develop and deploy mandatory training module.",
        40,
    ),
)
HOURS_WITHOUT_PLAN = 48

# --- fixed values: the manual process every alert is compared with -----------
MANUAL_HOURS = 960
MANUAL_COST = 150000
MANUAL_MONTHS = 6
MANUAL_RISK_PERCENT = 100
AUTOMATED_TIME_BAR = 0.1
AUTOMATED_TIME_LABEL = 6
AUTOMATED_RISK_PERCENT = 5
AUTOMATED_COST_THOUSANDS = 50
RISK_MITIGATION = "95%"
ALERTS_PER_YEAR = 200
COMPARISON = ("Processing Time", "Staff Effort", "Risk Exposure", "Financial Impact")
TILES = ("Time Reduction", "Cost Avoidance", "Risk Mitigation", "Processing Speed")
