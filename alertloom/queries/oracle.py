"""The same results in SQL, written apart from the Spark code.

Only fixed texts and values are shared. Texts with placeholders are spliced into
string concatenations.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from alertloom.fixed import analysis, codes, documents, records
from alertloom.queries import inputs
from alertloom.queries.inputs import AS_OF, LOADED_AT, SEED

ORACLE: dict[str, str] = {}

# --- building blocks ---------------------------------------------------------


def lit(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def fill(template: str, values: Mapping[str, str]) -> str:
    pieces = re.split(r"\{(\w+)\}", template)
    out = []
    for position, piece in enumerate(pieces):
        if position % 2:
            out.append(f"CAST(({values[piece]}) AS VARCHAR)")
        elif piece:
            out.append(lit(piece))
    return " || ".join(out)


def key(*columns: str) -> str:
    return (
        "concat_ws('|', "
        + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
        + ")"
    )


def digest(*columns: str, seed: object = None) -> str:
    prefix = "" if seed is None else f"'{seed}|' || "
    return f"md5({prefix}{key(*columns)})"


def number(*columns: str, seed: object) -> str:
    return f"CAST('0x' || substr({digest(*columns, seed=seed)}, 1, 8) AS BIGINT)"


def between(low: int, high: int, *columns: str, seed: object) -> str:
    return f"({low} + {number(*columns, seed=seed)} % {high - low + 1})"


def choice(options: Sequence[str], *columns: str, seed: object) -> str:
    listed = ", ".join(lit(o) for o in options)
    return f"([{listed}])[{between(1, len(options), *columns, seed=seed)}]"


def case(column: str, mapping: Mapping[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"(CASE {column} {whens} ELSE {default} END)"


def label(column: str, mapping: Mapping[str, str]) -> str:
    return case(column, mapping, lit(codes.UNKNOWN))


def filled(column: str) -> str:
    return f"({column} IS NOT NULL AND {column} <> '')"


def iso(date: str) -> str:
    return f"strftime({date}, '%Y-%m-%d')"


def day(offset: str = "0") -> str:
    return f"(DATE '{AS_OF}' + CAST({offset} AS INTEGER))"


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


SCEN = f"WITH scen AS ({inputs.SCENARIOS_SQL})"
ENTITY = "coalesce(drug_name, device_name, condition)"
COST = (
    "CAST(CASE risk_level "
    + " ".join(f"WHEN '{r}' THEN {c}" for r, c in analysis.COST_BY_RISK.items())
    + f" ELSE {analysis.COST_OTHERWISE} END AS BIGINT)"
)
BRIEFING = fill(analysis.BRIEFING, {"entity": f"coalesce({ENTITY}, 'None')"})

# --- readiness ---------------------------------------------------------------

COUNTS = (
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in inputs.TABLES
    )
    + f" UNION ALL SELECT '{inputs.ABSENT}', 0"
)
oracle("table_readiness", COUNTS)
oracle(
    "readiness_summary",
    f"WITH c AS ({COUNTS}) SELECT count(*) FILTER (row_count > 0) AS ready_tables, "
    "count(*) AS required_tables, CAST(sum(row_count) AS BIGINT) AS total_rows, "
    "bool_and(row_count > 0) AS all_ready FROM c",
)

# --- scenarios ---------------------------------------------------------------

oracle(
    "scenario_entity",
    f"{SCEN} SELECT scenario_id, {ENTITY} AS clinical_entity, "
    f"CASE WHEN {filled('drug_name')} THEN 'Drug' WHEN {filled('device_name')} "
    "THEN 'Device' ELSE 'Condition' END AS entity_type FROM scen",
)
FIELDS = (
    f"{ENTITY} AS clinical_entity, drug_name, device_name, condition, risk_level, "
    "old_warning, new_warning, clinical_significance, patient_safety_impact, "
    "manufacturer, compliance_deadline"
)
CRITICAL = (
    f"SELECT scenario_id, {FIELDS} FROM scen WHERE risk_level = 'Critical' "
    f"AND {ENTITY} IS NOT NULL"
)
oracle("critical_scenarios", f"{SCEN} {CRITICAL}")
BOTH = f"{filled('old_warning')} AND {filled('new_warning')}"
oracle(
    "scenario_previews",
    f"{SCEN} SELECT scenario_id, "
    f"CASE WHEN {BOTH} THEN old_warning[:60] || '...' END AS old_preview, "
    f"CASE WHEN {BOTH} THEN new_warning[:60] || '...' END AS new_preview, "
    f"CASE WHEN {filled('clinical_significance')} "
    "THEN clinical_significance[:80] || '...' END AS significance_preview FROM scen",
)
oracle(
    "latest_alert",
    "SELECT event_type || ' ' || props AS safety_alert, event_type AS product_type, "
    f"{iso('d')} AS alert_date FROM (SELECT *, CASE WHEN event_id % 5 <> 0 "
    "THEN CAST(ts AS DATE) END AS d FROM events) "
    "ORDER BY d DESC NULLS LAST, event_id LIMIT 1",
)
oracle(
    "scenario_pick",
    f"{SCEN} SELECT * FROM ({CRITICAL}) ORDER BY "
    f"{digest('scenario_id', seed=SEED)} LIMIT 1",
)
oracle(
    "scenario_fallback",
    "SELECT CAST(NULL AS BIGINT) AS scenario_id, "
    + ", ".join(
        f"CAST({lit(v)} AS VARCHAR) AS {k}" for k, v in analysis.DEMO_SCENARIO.items()
    ),
)

# --- answers and metrics -----------------------------------------------------

oracle("briefing_default", f"{SCEN} SELECT scenario_id, {BRIEFING} AS briefing FROM scen")
oracle(
    "financial_estimate",
    f"{SCEN} SELECT scenario_id, risk_level, {COST} AS financial_impact FROM scen",
)
oracle(
    "generated_number",
    f"{SCEN} SELECT scenario_id, CASE scenario_id % 6 WHEN 3 THEN 250000.5 "
    "WHEN 4 THEN CAST(scenario_id AS DOUBLE) WHEN 5 THEN CAST(scenario_id AS DOUBLE) "
    f"ELSE CAST({COST} AS DOUBLE) END AS financial_impact FROM scen",
)
SHARES = ", ".join(f"({lit(n)}, {s})" for n, s in analysis.COST_SHARES)
oracle(
    "cost_breakdown",
    f"{SCEN} SELECT scenario_id, f AS cost_factor, CAST(s AS BIGINT) AS share_percent, "
    f"CAST({COST} AS DOUBLE) * s / 100 AS amount FROM scen, (VALUES {SHARES}) v(f, s)",
)
PLAN = "(VALUES {}) plan(department, priority, key_action, estimated_hours)".format(
    ", ".join(
        f"({lit(d)}, {lit(p)}, {lit(a)}, CAST({h} AS BIGINT))"
        for d, p, a, h in analysis.ACTION_PLAN
    )
)
oracle(
    "action_plan",
    f"{SCEN}, crit AS ({CRITICAL}) SELECT scenario_id, department, priority, "
    f"key_action, estimated_hours FROM crit, {PLAN}",
)
oracle(
    "plan_hours",
    f"{SCEN} SELECT scenario_id, CAST(coalesce(sum(estimated_hours) FILTER "
    "(estimated_hours % 5 < scenario_id % 5), 48) AS BIGINT) AS total_hours "
    f"FROM scen, {PLAN} GROUP BY scenario_id",
)
MEASURED = (
    f"{SCEN}, m AS (SELECT scenario_id, k AS total_hours, {COST} AS financial_impact, "
    "960 - k AS time_saved, (960 - k) / 960.0::DOUBLE * 100 AS efficiency_gain, "
    f"150000 + {COST} AS cost_saved, "
    "CASE WHEN k <> 0 THEN 960.0::DOUBLE / k END AS speed_up FROM scen)"
)
oracle(
    "impact_metrics",
    f"{MEASURED} SELECT scenario_id, total_hours, financial_impact, time_saved, "
    "round(efficiency_gain, 4) AS efficiency_gain, cost_saved, "
    "round(speed_up, 4) AS speed_up FROM m",
)
COMPARED = (
    "(1, 'Processing Time', 6.0, 0.1, '6.0 mo', '6.0 min'), "
    "(2, 'Staff Effort', 960.0, total_hours, '960.0 hrs', "
    "printf('%.1f', total_hours::DOUBLE) || ' hrs'), "
    "(3, 'Risk Exposure', 100.0, 5.0, '100.0%', '5.0%'), "
    "(4, 'Financial Impact', financial_impact / 1000.0, 50.0, "
    "printf('%.1f', (financial_impact / 1000.0)::DOUBLE) || 'K', '50.0K')"
)
oracle(
    "impact_comparison",
    f"{MEASURED} SELECT scenario_id, CAST(p AS BIGINT) AS position, c AS category, "
    "CAST(mv AS DOUBLE) AS manual_value, CAST(av AS DOUBLE) AS automated_value, "
    "ml AS manual_label, al AS automated_label "
    f"FROM m, LATERAL (VALUES {COMPARED}) v(p, c, mv, av, ml, al)",
)
oracle(
    "stat_tiles",
    f"{MEASURED} SELECT scenario_id, t AS tile, f AS figure FROM m, LATERAL (VALUES "
    "('Time Reduction', printf('%.0f', efficiency_gain) || '%'), "
    "('Cost Avoidance', '$' || printf('%.0f', cost_saved / 1000.0::DOUBLE) || 'K'), "
    "('Risk Mitigation', '95%'), "
    "('Processing Speed', printf('%.0f', speed_up) || 'x Faster')) v(t, f)",
)
oracle(
    "annual_projection",
    f"{MEASURED} SELECT scenario_id, CAST(200 AS BIGINT) AS alerts_per_year, "
    "round(cost_saved::DOUBLE * 200 / 1000000, 4) AS annual_millions, "
    "'$' || printf('%.1f', cost_saved::DOUBLE * 200 / 1000000) || 'M+' AS annual_label "
    "FROM m",
)
oracle(
    "alert_analysis",
    f"{SCEN} SELECT scenario_id, {ENTITY} AS clinical_entity, risk_level, "
    f"compliance_deadline, {BRIEFING} AS briefing, "
    "CAST(750000 AS BIGINT) AS financial_impact, CAST(100 AS BIGINT) AS total_hours, "
    "CAST(860 AS BIGINT) AS time_saved, 89.5833::DOUBLE AS efficiency_gain, "
    "CAST(900000 AS BIGINT) AS cost_saved, 9.6::DOUBLE AS speed_up FROM scen "
    f"WHERE risk_level = 'Critical' AND {ENTITY} IS NOT NULL",
)

# --- cleaning ----------------------------------------------------------------

oracle(
    "parse_date_coerce",
    f"WITH d AS ({inputs.DATED_ORDERS_SQL}) SELECT o_orderkey, date_text, "
    r"CASE WHEN regexp_full_match(date_text, '\d{1,2}/\d{1,2}/\d{4}') "
    f"THEN {iso('''strptime(date_text, '%m/%d/%Y')''')} END AS alert_date FROM d",
)
oracle(
    "stamp_provenance",
    f"SELECT o_orderkey, o_orderpriority, '{LOADED_AT}' AS processed_at, "
    "'orders' AS source_file FROM orders",
)
oracle(
    "text_cast_nulls",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, "
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'nan' ELSE o_orderpriority END "
    "AS o_orderpriority FROM orders",
)
REC = f"WITH rec AS ({inputs.RECORDS_SQL})"
MEMO_SUBJECT = (
    f"CASE WHEN {filled('drug_name')} THEN drug_name WHEN {filled('device_name')} "
    "THEN device_name ELSE coalesce(condition, 'Clinical Update') END"
)
oracle("field_fallback", f"{REC} SELECT p_partkey, {MEMO_SUBJECT} AS subject FROM rec")
SUFFIXES = (" SOP.txt", " training.txt", " Device.pdf", " guidance.pdf", " notes.txt")


def document_type(name: str) -> str:
    return (
        f"CASE WHEN regexp_matches({name}, '(?i)protocol|sop') THEN 'CLINICAL_PROTOCOL' "
        f"WHEN regexp_matches({name}, '(?i)memo|training') THEN 'TRAINING_MATERIAL' "
        f"WHEN regexp_matches({name}, '(?i)manual|device') THEN 'DEVICE_MANUAL' "
        f"WHEN regexp_matches({name}, '(?i)guideline|guidance') "
        "THEN 'CLINICAL_GUIDELINE' ELSE 'GENERAL_CLINICAL' END"
    )


NAMED = f"p_name || {choice(SUFFIXES, 'p_partkey', seed=SEED)}"
oracle(
    "keyword_class",
    "SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%rod%' THEN 'ROUND' "
    "WHEN p_name ILIKE '%red%' OR p_name ILIKE '%small%' THEN 'MARKED' "
    "WHEN p_name ILIKE '%g%' THEN 'HAS_G' ELSE 'OTHER' END AS custom_class, "
    f"{document_type('n')} AS document_type "
    f"FROM (SELECT *, {NAMED} AS n FROM part)",
)
oracle(
    "document_manifest",
    "WITH p AS (SELECT octet_length(encode(html)) AS size, "
    "regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS stem "
    "FROM pages), f AS (SELECT size, "
    "(['memo.html', '.hidden.html', 'draft.tmp', 'Device_Manual.v2.pdf', 'readme'])"
    "[1 + size % 5] AS name, stem FROM p), "
    "u AS (SELECT *, 'store://bucket/hospital_documents/' || stem || '/' || name AS uri "
    "FROM f WHERE size % 5 NOT IN (1, 2)) "
    "SELECT md5(uri) AS document_id, name AS document_name, uri AS document_uri, "
    f"{document_type('name')} AS document_type, "
    "(['HTML', NULL, NULL, 'PDF', 'UNKNOWN'])[1 + size % 5] AS source_format, "
    f"'{LOADED_AT}' AS upload_timestamp, 'UPLOADED' AS processing_status, "
    "CAST(size AS BIGINT) AS file_size_bytes FROM u",
)
CODE = "CAST(l_partkey % 8 AS VARCHAR)"
oracle(
    "code_labels",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"{label(CODE, m)} AS {n}" for n, m in codes.CODE_MAPS.items())
    + ", 'Unknown' AS no_such_map FROM lineitem",
)
oracle(
    "lookup_join",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_suppkey % 30 AS code, "
    "coalesce(n_name, 'Unknown') AS label FROM lineitem LEFT JOIN nation "
    "ON n_nationkey = l_suppkey % 30",
)
REP = f"WITH rep AS ({inputs.REPORTS_SQL})"
YES_NO = "CASE WHEN fulfillexpeditecriteria = '1' THEN 'Yes' ELSE 'No' END"
SEX = "CASE WHEN sex = '1' THEN 'Male' WHEN sex = '2' THEN 'Female' ELSE 'Unknown' END"
oracle(
    "flag_labels",
    f"{REP} SELECT source_pos, {YES_NO} AS expedited, {SEX} AS sex FROM rep",
)
DOCUMENT = (
    """'{"a":{"list":[{"c":"' || user_id || '"},{"c":""},{"c":null}]},"props":' """
    """|| props || '}'"""
)
oracle(
    "json_path_default",
    f"SELECT event_id, coalesce(json_extract_string({DOCUMENT}, '$.props.k'), 'default') "
    "AS k, "
    f"coalesce(json_extract_string({DOCUMENT}, '$.props.z'), 'default') AS absent, "
    f"coalesce(json_extract_string({DOCUMENT}, '$.a.list[0].c'), 'default') AS first, "
    f"coalesce(json_extract_string({DOCUMENT}, '$.a.list[1].c'), 'default') AS blank, "
    f"coalesce(json_extract_string({DOCUMENT}, '$.a.list[2].c'), 'default') "
    "AS null_value, "
    f"coalesce(json_extract_string({DOCUMENT}, '$.a.list[9].c'), 'default') AS beyond, "
    f"coalesce(json_extract_string({DOCUMENT}, '$.a.x.y'), 'default') AS broken "
    "FROM events",
)
ROW_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "code")
oracle(
    "row_id",
    "WITH l AS (SELECT *, nullif(l_returnflag, 'N') AS code FROM lineitem) "
    f"SELECT {', '.join(ROW_KEY)}, {digest(*ROW_KEY)} AS id FROM l",
)

# --- reports -----------------------------------------------------------------


def drug_field(sql: str) -> str:
    return f"CASE WHEN has_drug THEN {sql} END"


FIRST = "(l_partkey + 1)"
oracle(
    "adverse_flatten",
    f"{REP} SELECT safetyreportid, receivedate, serious, "
    f"{label('reporttype', codes.REPORT_TYPE)} AS reporttype, "
    f"{YES_NO} AS fulfillexpeditecriteria, occurcountry, "
    f"{label('qualification', codes.QUALIFICATION)} AS reporter_qualification, "
    f"age AS patientonsetage, {SEX} AS patientsex, "
    f"{drug_field(f'''CAST('product-' || {FIRST} AS VARCHAR)''')} AS medicinalproduct, "
    f"{drug_field('''CASE WHEN l_partkey % 4 <> 0 THEN 'brand-' || l_partkey END''')} "
    "AS brand_name, "
    f"{drug_field('''CASE WHEN l_partkey % 5 <> 0 THEN 'maker-' || l_suppkey END''')} "
    "AS manufacturer_name, "
    + drug_field(
        label("CAST((l_suppkey + 1) % 5 AS VARCHAR)", codes.DRUG_CHARACTERIZATION)
    )
    + " AS drugcharacterization, "
    + drug_field(label(f"CAST({FIRST} % 8 AS VARCHAR)", codes.ACTION_DRUG))
    + " AS action_taken_with_drug, "
    f"{drug_field(''''use-' || (l_suppkey + 1)''')} AS drugindication, "
    f"{drug_field(lit('1 tablets'))} AS drugdosagetext, "
    "coalesce(array_to_string([coalesce(t, '') for t in terms], '; '), '') AS reactions, "
    f"coalesce(array_to_string([{label('o', codes.OUTCOME)} for o in outcomes], '; '), '') "
    "AS reaction_outcomes FROM rep",
)
oracle(
    "explode_reports",
    f"{REP} SELECT source_pos AS report, i - 1 AS source_pos, "
    "terms[i] AS reactionmeddrapt, outcomes[i] AS reactionoutcome "
    "FROM (SELECT source_pos, terms, outcomes, unnest(range(1, len(terms) + 1)) AS i "
    "FROM rep)",
)
SERIOUS = (
    "CASE WHEN serious = '1' THEN 'Critical' WHEN seriousnessother = '1' THEN 'High' "
    "ELSE 'Medium' END"
)
oracle("risk_seriousness", f"{REP} SELECT source_pos, {SERIOUS} AS risk_level FROM rep")
GRADE = "coalesce(classification, 'II')"
GRADE_RISK = case(GRADE, codes.RECALL_CLASS_RISK, "'Medium'")
RCL = f"WITH rcl AS ({inputs.RECALLS_SQL})"
oracle(
    "risk_recall_class",
    f"{RCL} SELECT source_pos, {GRADE} AS recall_class, {GRADE_RISK} AS risk_level "
    "FROM rcl",
)
DUE = between(14, 60, "o_orderkey", seed=SEED)
oracle(
    "deadlines",
    f"SELECT o_orderkey, {iso('CAST(o_orderdate AS DATE) + 30')} AS in_30, "
    f"{iso('CAST(o_orderdate AS DATE) + 90')} AS in_90, "
    f"{iso(f'CAST(o_orderdate AS DATE) + CAST({DUE} AS INTEGER)')} AS in_seeded "
    "FROM orders",
)

# --- canonical records -------------------------------------------------------


def canonical(
    texts: Mapping[str, str],
    fills: Mapping[str, str],
    values: Mapping[str, str],
    source: str,
    extra: str = "",
) -> str:
    """A SELECT of the 30 fields from a relation."""
    fields = []
    for name in codes.RECORD_FIELDS:
        if name in values:
            sql = values[name]
        elif name in texts:
            sql = fill(texts[name], fills)
        else:
            sql = "0" if name == "adverse_event_count" else "''"
        kind = "BIGINT" if name == "adverse_event_count" else "VARCHAR"
        fields.append(f"CAST({sql} AS {kind}) AS {name}")
    return f"SELECT {extra}{', '.join(fields)} FROM {source}"


TODAY = lit(AS_OF)
TRIAL_URL = f"{lit(records.TRIAL_URL)} || nct_id"
EVENT_URL = f"{lit(records.EVENT_URL)} || coalesce(safetyreportid, 'unknown')"
RECALL_URL = f"{lit(records.RECALL_URL)} || coalesce(recall_number, '')"
LABEL_URL = f"{lit(records.LABEL_URL)} || setid || '.json'"


def trial_records(source: str, extra: str = "") -> str:
    conditions = (
        "CASE WHEN has_conditions THEN first_condition || ', ' || second_condition "
        "ELSE '' END"
    )
    drugs = "['', 'agent-1', 'agent-1, agent-2', 'agent-1, agent-2', " \
        "'agent-1, agent-2, agent-4', 'agent-1, agent-2, agent-4']"
    return canonical(
        records.TRIAL_TEXT,
        {
            "conditions": conditions,
            "title": "coalesce(title, '')",
            "enrollment": "coalesce(enrolled, 0)",
        },
        {
            "drug_name": f"({drugs})[1 + drug_count]",
            "condition": f"left({conditions}, 100)",
            "update_date": TODAY,
            "source_url": TRIAL_URL,
            "clinical_trial_id": "nct_id",
            "manufacturer": "coalesce(sponsor, 'Trial Sponsor')",
            "regulatory_status": "status",
            "compliance_deadline": iso(day("90")),
            "trial_phase": "'PHASE' || phase || ', EXTENSION'",
            "study_status": "status",
        },
        source,
        extra,
    )


def event_records(source: str, extra: str = "") -> str:
    terms = "[t for t in terms[1:3] if t IS NOT NULL AND t <> '']"
    drug = "CASE WHEN has_drug THEN 'product-' || (l_partkey + 1) ELSE 'Unknown Drug' END"
    joined = f"coalesce(array_to_string({terms}, ', '), '')"
    return canonical(
        records.EVENT_TEXT,
        {
            "first_terms": f"coalesce(array_to_string(({terms})[1:2], ', '), '')",
            "drug": drug,
            "sex": "coalesce(sex, 'unknown')",
            "age": "coalesce(age, 'unknown')",
        },
        {
            "drug_name": drug,
            "condition": f"CASE WHEN len({terms}) = 0 THEN 'Adverse drug reaction' "
            f"ELSE {joined} END",
            "risk_level": SERIOUS,
            "update_date": TODAY,
            "source_url": EVENT_URL,
            "adverse_events": joined,
            "manufacturer": "coalesce(companynumb, 'Unknown')",
            "compliance_deadline": iso(day("30")),
            "adverse_event_count": f"len({terms})",
        },
        source,
        extra,
    )


def recall_records(source: str, extra: str = "") -> str:
    reason = "coalesce(reason_for_recall, 'Safety concern')"
    return canonical(
        records.RECALL_TEXT,
        {
            "class": GRADE,
            "reason": reason,
            "cause": "coalesce(root_cause_description, 'Device issue')",
        },
        {
            "device_name": "left(coalesce(product_description, 'Medical Device'), 100)",
            "old_indication": "coalesce(product_description, 'Medical device use')",
            "recall_reason": reason,
            "risk_level": GRADE_RISK,
            "update_date": f"coalesce(recall_initiation_date, {TODAY})",
            "source_url": RECALL_URL,
            "manufacturer": "coalesce(recalling_firm, 'Unknown Manufacturer')",
            "compliance_deadline": iso(day("30")),
            "recall_class": GRADE,
        },
        source,
        extra,
    )


def label_records(source: str, extra: str = "") -> str:
    def part(low: int, high: int, name: str) -> str:
        return between(low, high, LABEL_URL, seed=f"{SEED}-{name}")

    fillers = {"old_mg": part(25, 500, "old_mg"), "new_mg": part(10, 250, "new_mg")}

    def override(table: Mapping[str, Sequence[str]], index: int, default: str) -> str:
        known = {drug: pair[index] for drug, pair in table.items()}
        return case("lower(drug_name)", known, fill(default, fillers))

    approved = part(30, 1095, "approval")
    due = part(14, 60, "deadline")
    return canonical(
        records.LABEL_TEXT,
        {"drug": "drug_name"},
        {
            "drug_name": "drug_name",
            "condition": choice(
                records.LABEL_CONDITIONS, LABEL_URL, seed=f"{SEED}-condition"
            ),
            "old_dosage": override(
                records.LABEL_DOSAGE, 0, records.LABEL_DOSAGE_DEFAULT[0]
            ),
            "new_dosage": override(
                records.LABEL_DOSAGE, 1, records.LABEL_DOSAGE_DEFAULT[1]
            ),
            "old_warning": override(
                records.LABEL_WARNING, 0, records.LABEL_WARNING_DEFAULT[0]
            ),
            "new_warning": override(
                records.LABEL_WARNING, 1, records.LABEL_WARNING_DEFAULT[1]
            ),
            "risk_level": choice(records.LABEL_RISKS, LABEL_URL, seed=f"{SEED}-risk"),
            "fda_approval_date": iso(day(f"-{approved}")),
            "update_date": TODAY,
            "source_url": LABEL_URL,
            "ndc_code": f"{part(10000, 99999, 'ndc1')} || '-' || "
            f"{part(100, 999, 'ndc2')} || '-' || {part(10, 99, 'ndc3')}",
            "therapeutic_class": case(
                "category",
                {
                    "high_risk_drugs": "High Risk Drugs",
                    "oncology_drugs": "Oncology Drugs",
                    "cardiac_drugs": "Cardiac Drugs",
                    "psychiatric_drugs": "Psychiatric Drugs",
                },
                "NULL",
            ),
            "manufacturer": f"'Manufacturer ' || {part(100, 999, 'manufacturer')}",
            "compliance_deadline": iso(day(due)),
        },
        source,
        extra,
    )


TRI = f"WITH tri AS ({inputs.TRIALS_SQL})"
LAB = f"WITH lab AS ({inputs.LABELS_SQL})"
oracle("normalize_trials", f"{TRI} {trial_records('tri')} WHERE nct_id IS NOT NULL")
oracle("normalize_events", f"{REP} {event_records('rep')}")
oracle("normalize_recalls", f"{RCL} {recall_records('rcl')}")
oracle(
    "normalize_labels", f"{LAB} {label_records('lab')} WHERE {filled('setid')}"
)

# --- taking in ---------------------------------------------------------------


def ranked(terms: Sequence[str]) -> str:
    listed = ", ".join(f"({lit(t)}, {r})" for r, t in enumerate(terms, start=1))
    return f"(VALUES {listed}) w(term, term_rank)"


TRIAL_TERMS = ranked(records.TRIAL_CONDITIONS)
EVENT_TERMS = ranked([*records.EVENT_REACTIONS, *records.EVENT_FLAGS])
RECALL_TERMS = ranked([c.lower() for c in (*records.RECALL_CAUSES, *records.RECALL_CLASSES)])
LABEL_LIST = list(
    {d: c for c, ds in reversed(records.LABEL_DRUGS.items()) for d in reversed(ds)}.items()
)[::-1]
LABEL_TERMS = (
    "(VALUES "
    + ", ".join(
        f"({lit(d)}, {r}, {lit(c)})" for r, (d, c) in enumerate(LABEL_LIST, start=1)
    )
    + ") w(term, term_rank, list_category)"
)
MATCHED_TRIALS = (
    f"SELECT tri.*, term, term_rank FROM tri, {TRIAL_TERMS} WHERE status IN "
    "('RECRUITING', 'ACTIVE_NOT_RECRUITING', 'COMPLETED') AND has_conditions "
    "AND lower(first_condition) = term"
)
MATCHED_EVENTS = (
    f"SELECT rep.*, term, term_rank FROM rep, {EVENT_TERMS} "
    "WHERE list_contains([lower(t) for t in terms], term) OR (term = 'serious:1' AND serious = '1') "
    "OR (term = 'seriousnesshospitalization:1' AND seriousnesshospitalization = '1') "
    "OR (term = 'seriousnesslifethreatening:1' AND seriousnesslifethreatening = '1')"
)
MATCHED_RECALLS = (
    f"SELECT rcl.*, term, term_rank FROM rcl, {RECALL_TERMS} "
    "WHERE lower(root_cause_description) = term "
    "OR 'product_classification:' || lower(classification) = term"
)
MATCHED_LABELS = (
    "SELECT source_pos, setid, term AS drug_name, list_category AS category, term, "
    f"term_rank FROM lab, {LABEL_TERMS} WHERE lower(drug_name) = term"
)
RANK = "CAST(term_rank AS BIGINT) AS term_rank"
oracle(
    "terms_trials", f"{TRI}, m AS ({MATCHED_TRIALS}) SELECT source_pos, term, {RANK} FROM m"
)
oracle(
    "terms_events",
    f"{REP}, m AS ({MATCHED_EVENTS}) SELECT source_pos, safetyreportid, term, {RANK} "
    "FROM m",
)
oracle(
    "terms_recalls",
    f"{RCL}, m AS ({MATCHED_RECALLS}) SELECT source_pos, term, {RANK} FROM m",
)
oracle(
    "terms_labels",
    f"{LAB}, m AS ({MATCHED_LABELS}) SELECT source_pos, category, term, {RANK} FROM m",
)
oracle(
    "terms_table",
    f"WITH t AS (SELECT lower(([{', '.join(lit(w) for w in inputs.TERM_WORDS)}])"
    f"[1 + s_suppkey % {len(inputs.TERM_WORDS)}]) AS term, min(s_suppkey) AS term_rank "
    "FROM supplier GROUP BY 1) SELECT p_partkey, term, term_rank FROM part, t "
    "WHERE list_contains(string_split(lower(p_name), ' '), term)",
)
oracle("keyed_only", f"{LAB} SELECT source_pos, setid FROM lab WHERE {filled('setid')}")
FEED = f"WITH feed AS ({inputs.FEED_SQL})"
SEEN = f"SELECT DISTINCT source_url FROM feed WHERE k < {inputs.SEEN_BELOW}"
oracle(
    "cap_per_term",
    f"{FEED} SELECT term, source_pos, source_url FROM feed QUALIFY "
    "row_number() OVER (PARTITION BY term ORDER BY source_pos) <= 12",
)
oracle(
    "new_only",
    f"{FEED} SELECT source_pos, source_url FROM feed WHERE source_url NOT IN ({SEEN})",
)
FIRSTS = (
    "SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY source_url "
    "ORDER BY source_rank, source_pos) = 1"
)
oracle(
    "first_wins",
    f"{FEED}, f AS ({FIRSTS}) SELECT source_url, source, source_pos FROM f",
)
oracle(
    "source_counts",
    f"{FEED}, f AS ({FIRSTS}) SELECT source, count(*) AS new_items FROM f "
    f"WHERE source_url NOT IN ({SEEN}) GROUP BY source",
)
oracle("seen_state", f"{FEED} SELECT DISTINCT source_url FROM feed")
oracle(
    "union_sources",
    f"{LAB}, rcl AS ({inputs.RECALLS_SQL}) "
    "SELECT source_pos, setid AS key, drug_name, CAST(NULL AS VARCHAR) AS recalling_firm, "
    "'labels' AS source, CAST(1 AS BIGINT) AS source_rank FROM lab UNION ALL "
    "SELECT source_pos, recall_number, NULL, recalling_firm, 'recalls', 2 FROM rcl",
)
oracle(
    "demo_topup",
    "SELECT r AS run, 'Medical Device Recall' AS therapeutic_class, "
    "count(*) AS records, CAST(0 AS BIGINT) AS events "
    "FROM part, (VALUES ('plenty'), ('forced')) v(r) GROUP BY r UNION ALL "
    "SELECT r, 'High-Priority Clinical Update', 2, 245 "
    "FROM (VALUES ('short'), ('forced')) v(r)",
)
oracle(
    "sample_exact_n",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY "
    f"{digest('o_orderkey', seed=SEED)}, o_orderkey, o_custkey LIMIT 1000",
)


oracle(
    "sample_exact_large",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY "
    f"{digest('l_orderkey', 'l_linenumber', seed=SEED)}, "
    f"{digest('l_orderkey', 'l_linenumber', 'l_partkey', seed=SEED)} LIMIT 3000",
)


# Of each source: matched records, key, cap, records, and whether there is a key.
SOURCES = (
    ("labels", MATCHED_LABELS, LABEL_URL, records.LABEL_CAP, label_records, "setid IS NOT NULL"),
    ("events", MATCHED_EVENTS, EVENT_URL, records.EVENT_CAP, event_records, "true"),
    ("recalls", MATCHED_RECALLS, RECALL_URL, records.RECALL_CAP, recall_records, "true"),
    ("trials", MATCHED_TRIALS, TRIAL_URL, records.TRIAL_CAP, trial_records, "nct_id IS NOT NULL"),
)
LEADING_TERMS = {
    "labels": records.LABEL_TERM_LIMIT,
    "events": records.EVENT_TERM_LIMIT,
    "recalls": records.RECALL_TERM_LIMIT,
    "trials": records.TRIAL_TERM_LIMIT,
}


def leading(source: str) -> str:
    """The terms that a run with the page limits searches for."""
    limit = LEADING_TERMS[source]
    if source == "labels":
        listed = [lit(d) for ds in records.LABEL_DRUGS.values() for d in ds[:limit]]
        return f"term IN ({', '.join(listed)})"
    return f"term_rank <= {limit}"


def harvested(paged: bool) -> str:
    """The first record of each key, with source, rank, term and position."""
    parts = []
    ctes = [
        f"lab AS ({inputs.LABELS_SQL})",
        f"rep AS ({inputs.REPORTS_SQL})",
        f"rcl AS ({inputs.RECALLS_SQL})",
        f"tri AS ({inputs.TRIALS_SQL})",
    ]
    for rank, (name, matched, _, cap, build, keyed) in enumerate(SOURCES, start=1):
        terms = f" WHERE {leading(name)}" if paged else ""
        ctes.append(f"m_{name} AS (SELECT * FROM ({matched}){terms})")
        extra = (
            f"'{name}' AS source, {rank} AS source_rank, term_rank, source_pos, {cap} AS cap, "
        )
        parts.append(f"{build(f'm_{name}', extra)} WHERE {keyed}")
    first = (
        "SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY "
        f"source_rank, term_rank, source_pos, {digest(*codes.RECORD_FIELDS)}) = 1"
    )
    return (
        "WITH " + ", ".join(ctes) + ", found AS (" + " UNION ALL ".join(parts) + "), "
        f"firsts AS ({first})"
    )


RECORDS_OF = "* EXCLUDE (source_rank, term_rank, source_pos, cap)"
oracle(
    "harvest_records",
    f"{harvested(True)}, seen AS (SELECT {RECALL_URL} AS u FROM rcl) "
    f"SELECT {RECORDS_OF} FROM firsts WHERE source_url NOT IN "
    f"(SELECT u FROM seen WHERE {number('u', seed=SEED)} % 2 = 0) "
    "QUALIFY row_number() OVER (PARTITION BY source, term_rank "
    "ORDER BY source_pos, source_url) <= cap",
)
oracle("harvest_uncapped", f"{harvested(False)} SELECT {RECORDS_OF} FROM firsts")
oracle("harvest_rounds", f"{harvested(False)} SELECT {RECORDS_OF} FROM firsts")
oracle(
    "cap_large",
    f"{FEED} SELECT term, source_pos, source_url FROM feed QUALIFY "
    "row_number() OVER (PARTITION BY term ORDER BY source_pos) <= 1500",
)

# --- corpus ------------------------------------------------------------------


def pick_template(options: Sequence[str]) -> str:
    return choice(options, "p_partkey", seed=f"{SEED}-template")


ROUTE = (
    f"CASE WHEN {filled('device_name')} AND {filled('recall_reason')} "
    "THEN 'device_manual' "
    f"WHEN {filled('drug_name')} THEN {pick_template(documents.DRUG_TEMPLATES)} "
    f"WHEN {filled('condition')} THEN {pick_template(documents.CONDITION_TEMPLATES)} "
    f"ELSE {pick_template(documents.OTHER_TEMPLATES)} END"
)


def frame(template: str, subject: str, ages: tuple[int, int]) -> dict[str, str]:
    title = fill(documents.TEMPLATES[template][0], {"subject": subject})
    age = between(*ages, "p_partkey", seed=f"{SEED}-{template}-age")
    return {
        "title": title,
        "underline": f"repeat('=', length({title}))",
        "subject": subject,
        "today": f"strftime({day()}, '%B %d, %Y')",
        "revised": f"strftime({day(f'-{age}')}, '%B %Y')",
        "number": between(1000, 9999, "p_partkey", seed=f"{SEED}-{template}-number"),
    }


def defaults(table: Mapping[str, str]) -> dict[str, str]:
    return {name: f"coalesce({name}, {lit(text)})" for name, text in table.items()}


def optional(template: str, name: str) -> str:
    return f"CASE WHEN {filled(name)} THEN {fill(template, {name: name})} ELSE '' END"


MEMO = fill(
    documents.MEMO,
    {
        **frame("training_memo", MEMO_SUBJECT, (90, 365)),
        **defaults(documents.MEMO_DEFAULTS),
        "dosage_line": optional(documents.MEMO_DOSAGE_LINE, "old_dosage"),
        "warning_line": optional(documents.MEMO_WARNING_LINE, "old_warning"),
        "indication_line": optional(documents.MEMO_INDICATION_LINE, "old_indication"),
    },
)
ALERT_SUBJECT = (
    f"CASE WHEN {filled('drug_name')} THEN drug_name "
    "ELSE coalesce(device_name, 'Clinical Safety Issue') END"
)
ALERT = fill(
    documents.ALERT,
    {
        **frame("safety_alert", ALERT_SUBJECT, (30, 180)),
        **defaults(documents.ALERT_DEFAULTS),
        "issue": f"CASE WHEN {filled('recall_reason')} THEN "
        f"{fill(documents.ALERT_RECALL_ISSUE, {'recall_reason': 'recall_reason'})} "
        f"WHEN {filled('new_warning')} THEN {lit(documents.ALERT_WARNING_ISSUE)} "
        f"ELSE {lit(documents.ALERT_OTHER_ISSUE)} END",
    },
)
SUMMARY_SUBJECT = (
    f"CASE WHEN {filled('condition')} THEN condition "
    "ELSE coalesce(drug_name, 'Clinical Research') END"
)
SUMMARY = fill(
    documents.SUMMARY,
    {
        **frame("research_summary", SUMMARY_SUBJECT, (60, 300)),
        **defaults(documents.SUMMARY_DEFAULTS),
        "trial_line": optional(documents.SUMMARY_TRIAL_LINE, "clinical_trial_id"),
        "next_review": f"strftime({day('365')}, '%B %Y')",
    },
)


def page(template: str, subject: str, fields: Mapping, choices: Mapping) -> dict[str, str]:
    values = frame(template, subject, documents.PAGE_AGE_DAYS[template])
    values |= {slot: f"coalesce(CAST({name} AS VARCHAR), {lit(default)})" for slot, (name, default) in fields.items()}
    return values | {
        slot: choice(options, "p_partkey", seed=f"{SEED}-{template}-{slot}") for slot, options in choices.items()
    }


def page_texts() -> dict[str, str]:
    texts = {}
    drug = f"coalesce(drug_name, {lit(documents.PROTOCOL_SUBJECT_DEFAULT)})"
    for template in ("medication_protocol", "formulary_entry"):
        values = page(template, drug, documents.PROTOCOL_FIELDS, documents.PROTOCOL_CHOICES)
        values["approved"] = f"coalesce(fda_approval_date, {iso(day())})"
        texts[template] = fill(documents.PROTOCOL, values)
    device = f"coalesce(device_name, {lit(documents.MANUAL_SUBJECT_DEFAULT)})"
    values = page("device_manual", device, documents.MANUAL_FIELDS, documents.MANUAL_CHOICES)
    notice = fill(documents.MANUAL_RECALL, values | {"recall_reason": "recall_reason"})
    values["recall"] = f"CASE WHEN {filled('recall_reason')} THEN {notice} ELSE '' END"
    texts["device_manual"] = fill(documents.MANUAL, values)
    condition = f"coalesce(condition, {lit(documents.GUIDELINE_SUBJECT_DEFAULT)})"
    values = page("clinical_guideline", condition, documents.GUIDELINE_FIELDS, documents.GUIDELINE_CHOICES)
    therapy = fill(documents.GUIDELINE_DRUG, values | {"drug_name": "drug_name"})
    values["therapy"] = f"CASE WHEN {filled('drug_name')} THEN {therapy} ELSE '' END"
    texts["clinical_guideline"] = fill(documents.GUIDELINE, values)
    procedure = (
        f"CASE WHEN {filled('drug_name')} THEN drug_name "
        f"ELSE coalesce(condition, {lit(documents.NURSING_SUBJECT_DEFAULT)}) END"
    )
    values = page("nursing_protocol", procedure, documents.NURSING_FIELDS, documents.NURSING_CHOICES)
    values["updated"] = f"coalesce(CAST(update_date AS VARCHAR), {iso(day())})"
    given = fill(documents.NURSING_DRUG, values | {"drug_name": "drug_name"})
    values["care"] = f"CASE WHEN {filled('drug_name')} THEN {given} ELSE {fill(documents.NURSING_CARE, values)} END"
    texts["nursing_protocol"] = fill(documents.NURSING, values)
    return texts


PAGE_TEXTS = page_texts()
TEXT = (
    f"CASE template WHEN 'training_memo' THEN {MEMO} WHEN 'safety_alert' THEN {ALERT} "
    f"WHEN 'research_summary' THEN {SUMMARY} "
    + " ".join(f"WHEN {lit(name)} THEN {body}" for name, body in PAGE_TEXTS.items())
    + " END"
)
oracle("template_route", f"{REC} SELECT p_partkey, {ROUTE} AS template FROM rec")
oracle(
    "seeded_values",
    "SELECT l_orderkey, l_linenumber, "
    f"{between(30, 1825, 'l_orderkey', 'l_linenumber', seed=SEED)} AS days, "
    f"{choice(('a', 'b', 'c'), 'l_orderkey', 'l_partkey', seed=SEED)} AS choice, "
    f"{number('l_orderkey', seed=SEED)} % 1000000 < 200000 AS sampled FROM lineitem",
)
oracle("render_memo", f"{REC} SELECT p_partkey, {MEMO} AS text FROM rec")
oracle("render_alert", f"{REC} SELECT p_partkey, {ALERT} AS text FROM rec")
oracle(
    "render_pages",
    f"{REC} SELECT p_partkey, " + ", ".join(f"{body} AS {name}" for name, body in PAGE_TEXTS.items()) + " FROM rec",
)
oracle("render_summary", f"{REC} SELECT p_partkey, {SUMMARY} AS text FROM rec")
NAME_SUBJECT = MEMO_SUBJECT.replace("'Clinical Update'", "'clinical'")
WRITTEN = iso(day(f"-{between(30, 1825, 'p_partkey', seed=f'{SEED}-age')}"))


def named(template: str, ending: str) -> str:
    return (
        f"{WRITTEN} || '_' || {template} || '_' || p_partkey || '_' || "
        rf"regexp_replace(left({NAME_SUBJECT}, 15), '[^\p{{L}}\p{{N}}]', '', 'g') "
        f"|| '.' || {ending}"
    )


FORMAT = case("template", {n: s[1] for n, s in documents.TEMPLATES.items()}, "NULL")
IMAGE = f"{number('p_partkey', seed=f'{SEED}-image')} % 1000000 < 200000"
DOC = f"{REC}, doc AS (SELECT *, {ROUTE} AS template FROM rec)"
oracle(
    "corpus_file_name",
    f"{DOC} SELECT p_partkey, {FORMAT} AS format, {named('template', FORMAT)} "
    f"AS file_name, {named(lit('screenshot'), lit('jpg'))} AS image_name FROM doc",
)
oracle(
    "corpus_documents",
    f"{DOC} SELECT p_partkey, template, {named('template', FORMAT)} AS file_name, "
    f"{TEXT} AS text, {IMAGE} AS has_image FROM doc",
)
KINDS = ", ".join(f"({lit(n)})" for n in documents.TEMPLATES)
oracle(
    "corpus_stats",
    f"{DOC}, c AS (SELECT kind, count(template) AS documents FROM (VALUES {KINDS}) k(kind) "
    "LEFT JOIN doc ON template = kind GROUP BY kind UNION ALL "
    f"SELECT 'images', count(*) FROM doc WHERE {IMAGE}) "
    "SELECT * FROM c UNION ALL SELECT 'total', CAST(sum(documents) AS BIGINT) FROM c",
)
oracle(
    "corpus_fields",
    f"{DOC}, t AS (SELECT p_partkey, template, {TEXT} AS text FROM doc "
    "WHERE template IN ('training_memo', 'safety_alert', 'research_summary')) "
    "SELECT p_partkey, split_part(text, chr(10), 1) AS title, "
    r"regexp_extract(text, '\n(?:Risk level|Alert Level): ([^\n]*)', 1) AS risk_level, "
    r"regexp_extract(text, '\n(?:Document|Alert|Summary) ID: ([^\n]*)', 1) "
    "AS document_number, "
    "array_to_string([line[:-2] for line in string_split(text, chr(10)) "
    "if regexp_full_match(line, '[A-Z][A-Z ]+:')], '|') AS sections, "
    "trim(substr(split_part(text, chr(10), 1), "
    "strpos(split_part(text, chr(10), 1), ':') + 1)) AS subject FROM t",
)

# --- files -------------------------------------------------------------------

EVENT_KINDS = {"serious": "BIGINT", "patientonsetage": "DOUBLE"}
EVENT_CELLS = {
    c: f"CAST(nullif(CAST({c} AS VARCHAR), '') AS {EVENT_KINDS.get(c, 'VARCHAR')})"
    for c in codes.EVENT_FIELDS
}
BROKEN_CELLS = EVENT_CELLS | {
    "reactions": "reactions || chr(13) || chr(10) || '\"a\",' || chr(10) || safetyreportid"
}
oracle(
    "csv_line_breaks",
    f"SELECT {', '.join(f'{sql} AS {c}' for c, sql in BROKEN_CELLS.items())} "
    f"FROM ({ORACLE['adverse_flatten']}) f",
)
EVENT_CELLS["drugindication"] = (
    f"CASE WHEN occurcountry IS NOT NULL THEN {EVENT_CELLS['drugindication']} END"
)
oracle(
    "csv_roundtrip",
    f"SELECT {', '.join(f'{sql} AS {c}' for c, sql in EVENT_CELLS.items())} "
    f"FROM ({ORACLE['adverse_flatten']}) f",
)
oracle("landed_lines", ORACLE["adverse_flatten"])
oracle(
    "landed_responses",
    f"{RCL} SELECT recall_number, product_description, reason_for_recall, classification, "
    "recalling_firm, recall_initiation_date, root_cause_description, "
    "row_number() OVER (PARTITION BY source_pos // 200 ORDER BY source_pos) - 1 "
    "AS source_pos FROM rcl",
)
RECORD_CELLS = ", ".join(
    f"CAST(nullif(CAST({c} AS VARCHAR), '') AS "
    f"{'BIGINT' if c == 'adverse_event_count' else 'VARCHAR'}) AS {c}"
    for c in codes.RECORD_FIELDS
)
oracle("newest_records", f"SELECT {RECORD_CELLS} FROM ({ORACLE['normalize_recalls']}) r")
oracle("key_state_files", ORACLE["seen_state"])
oracle(
    "table_writes",
    "SELECT o_orderkey, o_custkey, (['replaced', 'appended', 'new'])[1 + o_orderkey % 3] "
    "AS step FROM orders",
)
oracle(
    "file_listing",
    "SELECT 'part=' || page_id % 4 AS part, "
    "CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS bytes "
    "FROM pages WHERE html IS NOT NULL GROUP BY 1",
)
oracle(
    "row_audits",
    "SELECT 'orders' AS table_name, count(*) AS audited, count(*) AS written FROM orders "
    "UNION ALL SELECT 'lineitem', count(*), count(*) FROM lineitem",
)
oracle("corpus_table", f"SELECT file_name, template, text FROM ({ORACLE['corpus_documents']}) c")

# --- generation --------------------------------------------------------------


def shown(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'None')"


BRIEFING_PROMPT = fill(
    analysis.BRIEFING_PROMPT,
    {
        "entity": shown(ENTITY),
        "risk": shown("risk_level"),
        "old_warning": shown("old_warning"),
        "new_warning": shown("new_warning"),
        "significance": shown("clinical_significance"),
    },
)
COST_PROMPT = fill(
    analysis.COST_PROMPT,
    {
        "entity": shown(ENTITY),
        "risk": shown("risk_level"),
        "impact": shown("patient_safety_impact"),
        "significance": shown("clinical_significance"),
    },
)
PLAN_PROMPT = fill(
    analysis.PLAN_PROMPT, {"briefing": BRIEFING, "cost": f"format('{{:,}}', {COST})"}
)
oracle(
    "prompt_text",
    f"{SCEN} SELECT scenario_id, {BRIEFING_PROMPT} AS briefing_prompt, "
    f"{COST_PROMPT} AS cost_prompt, {PLAN_PROMPT} AS plan_prompt FROM scen",
)
oracle(
    "response_unpack",
    f"{SCEN} SELECT scenario_id, CASE WHEN scenario_id % 6 < 3 THEN 'note ' || scenario_id "
    f"ELSE {BRIEFING} END AS briefing, CASE scenario_id % 6 WHEN 0 THEN 'STOP' "
    "WHEN 1 THEN 'MAX_TOKENS' WHEN 2 THEN 'STOP' END AS finish_reason, "
    "scenario_id % 6 = 1 AS is_truncated FROM scen",
)
TRUNCATED = "a[1] IN ('1', '2', '3', '4', '5')"
oracle(
    "generate_text_batch",
    f"{SCEN}, p AS (SELECT *, md5({BRIEFING_PROMPT}) AS a FROM scen) SELECT scenario_id, "
    f"CASE WHEN a[1] = '0' THEN {BRIEFING} ELSE 'Answer ' || a END AS briefing, "
    f"CASE WHEN a[1] = '0' THEN NULL WHEN {TRUNCATED} THEN 'MAX_TOKENS' ELSE 'STOP' END "
    f"AS finish_reason, {TRUNCATED} AS is_truncated FROM p",
)
GIVEN = "CAST('0x' || a[2:5] AS BIGINT) % 1000"
oracle(
    "generate_double_batch",
    f"{SCEN}, p AS (SELECT *, md5({COST_PROMPT}) AS a FROM scen) SELECT scenario_id, "
    f"CASE WHEN a[1] IN ('0', 'f') OR {GIVEN} = 0 THEN CAST({COST} AS DOUBLE) "
    f"ELSE CAST({GIVEN} AS DOUBLE) END AS financial_impact FROM p",
)
oracle(
    "generate_table_batch",
    f"{SCEN}, p AS (SELECT *, md5({COST_PROMPT}) AS a FROM scen) "
    "SELECT scenario_id, department, priority, key_action, estimated_hours FROM p, "
    f"{PLAN} WHERE a[1] IN ('0', 'f') UNION ALL "
    f"SELECT scenario_id, 'unit ' || a[6], 'HIGH', 'act on ' || a, {GIVEN} FROM p "
    "WHERE a[1] NOT IN ('0', 'f') UNION ALL "
    "SELECT scenario_id, 'Pharmacy', 'URGENT', 'review', 5 FROM p "
    "WHERE a[1] NOT IN ('0', 'f')",
)



def given(column: str) -> str:
    return f"CAST('0x' || {column}[2:5] AS BIGINT) % 1000"


ASKED_PLAN = fill(
    analysis.PLAN_PROMPT,
    {"briefing": "briefing", "cost": "format('{:,}', CAST(financial_impact AS BIGINT))"},
)
PLAN_STEPS = len(analysis.ACTION_PLAN)
PLAN_HOURS = sum(hours for *_, hours in analysis.ACTION_PLAN)
oracle(
    "alert_analysis_backend",
    f"{SCEN}, p AS (SELECT *, md5({BRIEFING_PROMPT}) AS a, md5({COST_PROMPT}) AS c "
    f"FROM scen WHERE risk_level = 'Critical' AND {ENTITY} IS NOT NULL), "
    "q AS (SELECT scenario_id, a, c, CASE WHEN a[1] IN ('0', '9') "
    f"THEN {BRIEFING} ELSE 'Answer ' || a END AS briefing, "
    f"CAST(CASE WHEN c[1] IN ('0', '9', 'f') OR {given('c')} = 0 THEN {COST} "
    f"ELSE {given('c')} END AS DOUBLE) AS financial_impact FROM p), "
    f"r AS (SELECT *, md5({ASKED_PLAN}) AS b FROM q), "
    "s AS (SELECT *, b[1] IN ('0', '9', 'f') AS fixed_plan FROM r), "
    f"t AS (SELECT *, CAST(CASE WHEN fixed_plan THEN {PLAN_HOURS} ELSE {given('b')} + 5 END "
    "AS BIGINT) AS total_hours FROM s) SELECT scenario_id, briefing, "
    f"CASE WHEN a[1] IN ('0', '9') THEN NULL WHEN {TRUNCATED} THEN 'MAX_TOKENS' "
    f"ELSE 'STOP' END AS finish_reason, {TRUNCATED} AS is_truncated, financial_impact, "
    f"CAST(CASE WHEN fixed_plan THEN {PLAN_STEPS} ELSE 2 END AS BIGINT) AS steps, "
    f"total_hours, {analysis.MANUAL_HOURS} - total_hours AS time_saved, "
    f"round(({analysis.MANUAL_HOURS} - total_hours) / {analysis.MANUAL_HOURS}.0::DOUBLE "
    "* 100, 4) AS efficiency_gain, "
    f"{analysis.MANUAL_COST} + financial_impact AS cost_saved, "
    f"round({analysis.MANUAL_HOURS}.0::DOUBLE / total_hours, 4) AS speed_up, "
    "CAST((a[1] = '9')::INT + (b[1] = '9')::INT + (c[1] = '9')::INT AS BIGINT) "
    "AS failed_calls FROM t",
)

# --- streaming ---------------------------------------------------------------

STREAM_URL = "'https://records.invalid/' || user_id || '/' || props"
oracle("stream_new_only", f"SELECT DISTINCT {STREAM_URL} AS source_url FROM events")
oracle(
    "key_store_rounds",
    "SELECT user_id AS key, event_id, run FROM (SELECT user_id, event_id % 10 AS run, min(event_id) AS event_id "
    "FROM events GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY run) = 1",
)
oracle(
    "atomic_commit",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 < 2 THEN 1 ELSE 2 END AS load FROM orders",
)
oracle(
    "stream_to_table",
    f"SELECT {STREAM_URL} AS source_url, min(event_id) AS event_id FROM events GROUP BY 1",
)

# --- matching ----------------------------------------------------------------

WORDS = r"string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')"
oracle(
    "affected_documents",
    f"WITH b AS (SELECT {WORDS} AS w FROM benchmark), "
    "e AS (SELECT array_to_string(w[1:n], ' ') AS clinical_entity "
    "FROM b, (VALUES (2), (6), (1000000)) v(n) UNION "
    f"SELECT array_to_string({WORDS.replace('lower(text)', 'lower(p_name)')}, ' ') FROM part), "
    f"d AS (SELECT doc_id, ' ' || array_to_string({WORDS}, ' ') || ' ' AS body "
    "FROM documents) SELECT clinical_entity, doc_id FROM e JOIN d "
    "ON contains(body, ' ' || clinical_entity || ' ')",
)
oracle(
    "phrase_index",
    f"WITH b AS (SELECT {WORDS} AS w FROM benchmark), "
    "e AS (SELECT DISTINCT w[1:n] AS p FROM b, (VALUES (1), (2), (4), (9), (1000000)) v(n)), "
    f"d AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE doc_id % 7 <> 0), "
    "t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d), "
    "f AS (SELECT p, doc_id, i FROM e JOIN t ON t.word = p[1]) "
    "SELECT array_to_string(p, ' ') AS clinical_entity, f.doc_id, count(*) AS times "
    "FROM f JOIN d ON d.doc_id = f.doc_id AND d.w[i:i + len(p) - 1] = p GROUP BY ALL",
)
oracle(
    "vector_topk",
    "WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0) "
    "SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], "
    "(SELECT v FROM q)), 6) AS similarity FROM embeddings WHERE vec_id <> 0 "
    "ORDER BY similarity DESC, vec_id LIMIT 10",
)
