"""Stand-ins: the given tables in the shapes the operators expect.

Flat columns are written once, in SQL that Spark and DuckDB both read. Nested
columns are written for each engine. Every row comes from one row of a table,
so the stand-ins grow with it and gather nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
    "p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, "
    "l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, "
    "l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
ABSENT = "absent_table"
AS_OF = "2025-09-14"
LOADED_AT = "2025-09-14 08:30:00"
SEED = 42


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _values(expressions: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in expressions.items()]


def _select(expressions: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(_values(expressions))} FROM {source}"


def _choose(options, index: str) -> str:
    """CASE over small integers; None gives null."""
    cases = " ".join(
        f"WHEN {i} THEN " + ("NULL" if o is None else f"'{o}'")
        for i, o in enumerate(options)
    )
    return f"CASE {index} {cases} END"


def _text(sql: str) -> str:
    return f"CAST({sql} AS VARCHAR(20))"


# --- events as scenarios -----------------------------------------------------

SPARK_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"
DUCK_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _scenario_columns(k: str, deadline: str) -> dict[str, str]:
    user = "CAST(user_id AS VARCHAR(20))"
    blank = "event_type = 'purchase' AND event_id % 7 = 0"
    return {
        "scenario_id": "event_id",
        "drug_name": f"CASE WHEN {blank} THEN '' "
        f"WHEN event_type = 'purchase' THEN 'drug-' || {user} END",
        "device_name": f"CASE WHEN event_type = 'error' OR ({blank}) "
        f"THEN 'device-' || {user} END",
        "condition": f"CASE WHEN event_type = 'view' THEN 'condition-' || {user} END",
        "risk_level": _choose(("Critical", "High", "Medium"), "event_id % 3"),
        "old_warning": f"'Guidance level ' || {_text(k)} || "
        "CASE WHEN event_id % 4 = 0 THEN repeat(' as before', 8) ELSE '' END",
        "new_warning": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE "
        f"'Guidance level ' || {_text(f'{k} + 100')} END",
        "clinical_significance": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE "
        f"'Signal from user ' || {user} || repeat(' again', 14) END",
        "patient_safety_impact": f"'Impact group ' || {_text('user_id % 10')}",
        "manufacturer": f"'Maker ' || {_text('user_id % 50')}",
        "compliance_deadline": deadline,
        "k": k,
    }


def scenarios(spark: SparkSession, folder: str) -> DataFrame:
    deadline = "date_format(date_add(CAST(ts AS DATE), 30), 'yyyy-MM-dd')"
    columns = _scenario_columns(SPARK_K, deadline)
    return table(spark, folder, "events").selectExpr(*_values(columns))


SCENARIOS_SQL = _select(
    _scenario_columns(DUCK_K, "strftime(CAST(ts AS DATE) + 30, '%Y-%m-%d')"), "events"
)

# --- events as a feed of five sources ----------------------------------------

SOURCES = ("purchase", "error", "view", "click", "signup")


def _feed_columns(k: str) -> dict[str, str]:
    rank = "CASE event_type " + " ".join(
        f"WHEN '{s}' THEN {i}" for i, s in enumerate(SOURCES, start=1)
    )
    return {
        "source_pos": "event_id",
        "source": "event_type",
        "source_rank": f"{rank} END",
        "term": "user_id",
        "k": k,
        "source_url": "'https://records.invalid/' || "
        f"CAST(user_id AS VARCHAR(20)) || '/' || {_text(k)}",
    }


def feed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*_values(_feed_columns(SPARK_K)))


FEED_SQL = _select(_feed_columns(DUCK_K), "events")
SEEN_BELOW = 20
TERM_WORDS = ("Ring", "gizmo", "RED", "absent", "bolt")

# --- line items as adverse-event reports -------------------------------------

REACTION_TERMS = (
    "headache",
    "Nausea",
    "dizziness",
    "fatigue",
    "Abdominal Pain",
    "rash",
    "fever",
    None,
    "",
)


def _report_columns(received: str) -> dict[str, str]:
    return {
        "source_pos": "l_orderkey * 8 + l_linenumber",
        "safetyreportid": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE "
        + " || '-' || ".join(
            _text(c)
            for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        )
        + " END",
        "receivedate": received,
        "serious": "CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' END",
        "seriousnessother": "CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END",
        "seriousnesshospitalization": _choose(("1", "2", None), "l_partkey % 3"),
        "seriousnesslifethreatening": "CASE WHEN l_suppkey % 11 = 0 THEN '1' END",
        "reporttype": _text("l_partkey % 6"),
        "fulfillexpeditecriteria": _choose(("1", "2", None), "l_suppkey % 3"),
        "occurcountry": _choose(("US", None), "l_suppkey % 2"),
        "companynumb": "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE "
        f"'company-' || {_text('l_suppkey')} END",
    }


def _first_of(items: list[str], count: str) -> str:
    """An array of the first few of the items."""
    return f"slice(array({', '.join(items)}), 1, CAST({count} AS INT))"


def reports(spark: SparkSession, folder: str) -> DataFrame:
    terms = ", ".join("NULL" if t is None else f"'{t}'" for t in REACTION_TERMS)
    openfda = (
        "named_struct('brand_name', if(l_partkey % 4 = 0, "
        "CAST(array() AS array<string>), array('brand-' || CAST(l_partkey AS STRING))), "
        "'manufacturer_name', if(l_partkey % 5 = 0, NULL, "
        "array('maker-' || CAST(l_suppkey AS STRING))))"
    )
    drugs = [
        "named_struct("
        f"'medicinalproduct', 'product-' || CAST(l_partkey + {i} AS STRING), "
        f"'drugindication', 'use-' || CAST(l_suppkey + {i} AS STRING), "
        f"'drugdosagetext', '{i} tablets', "
        f"'actiondrug', CAST((l_partkey + {i}) % 8 AS STRING), "
        f"'drugcharacterization', CAST((l_suppkey + {i}) % 5 AS STRING), "
        f"'openfda', {openfda})"
        for i in (1, 2)
    ]
    reactions = [
        "named_struct("
        f"'reactionmeddrapt', get(array({terms}), CAST((l_partkey + {i}) % 9 AS INT)), "
        f"'reactionoutcome', nullif(CAST((l_suppkey + {i}) % 8 AS STRING), '7'))"
        for i in range(1, 7)
    ]
    columns = _report_columns("date_format(l_shipdate, 'yyyyMMdd')")
    return table(spark, folder, "lineitem").selectExpr(
        *_values(columns),
        "named_struct('qualification', CAST(l_suppkey % 7 AS STRING)) AS primarysource",
        "named_struct("
        "'patientonsetage', if(l_partkey % 5 = 0, NULL, "
        "CAST(CAST(l_quantity AS BIGINT) AS STRING)), "
        "'patientsex', nullif(CAST(l_partkey % 4 AS STRING), '3'), "
        f"'drug', {_first_of(drugs, 'l_partkey % 3')}, "
        f"'reaction', {_first_of(reactions, 'l_linenumber - 1')}) AS patient",
    )


def _reports_sql() -> str:
    terms = ", ".join("NULL" if t is None else f"'{t}'" for t in REACTION_TERMS)
    flat = _select(
        _report_columns("strftime(l_shipdate, '%Y%m%d')"), "lineitem"
    ).removesuffix(" FROM lineitem")
    return (
        f"{flat}, CAST(l_suppkey % 7 AS VARCHAR) AS qualification, "
        "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE "
        "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS age, "
        "nullif(CAST(l_partkey % 4 AS VARCHAR), '3') AS sex, "
        "l_partkey % 3 > 0 AS has_drug, l_partkey, l_suppkey, "
        f"[([{terms}])[1 + ((l_partkey + i) % 9)] for i in range(1, l_linenumber)] "
        "AS terms, "
        "[CASE WHEN (l_suppkey + i) % 8 = 7 THEN NULL ELSE "
        "CAST((l_suppkey + i) % 8 AS VARCHAR) END for i in range(1, l_linenumber)] "
        "AS outcomes FROM lineitem"
    )


REPORTS_SQL = _reports_sql()

# --- parts as device recalls -------------------------------------------------

_RECALL_COLUMNS = {
    "source_pos": "p_partkey",
    "recall_number": f"CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE 'Z-' || {_text('p_partkey')} END",
    "product_description": "CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE "
    "p_name || ' ' || p_type || ' ' || p_brand || repeat(' unit', p_size) END",
    "reason_for_recall": "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 'Fault in ' || p_name END",
    "classification": _choose(("I", "II", "III", "Class I", None), "p_size % 5"),
    "recalling_firm": "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END",
    "recall_initiation_date": "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE "
    f"'2024-01-' || lpad({_text('1 + p_size % 28')}, 2, '0') END",
    "root_cause_description": _choose(
        ("Device Design", "Software", "Manufacturing", None), "p_partkey % 4"
    ),
}


def recalls(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(*_values(_RECALL_COLUMNS))


RECALLS_SQL = _select(_RECALL_COLUMNS, "part")

# --- orders as clinical trials -----------------------------------------------

_TRIAL_COLUMNS = {
    "source_pos": "o_orderkey",
    "nct_id": "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' "
    f"ELSE 'NCT' || lpad({_text('o_orderkey')}, 8, '0') END",
    "title": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE 'Study of ' || o_orderpriority END",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RECRUITING' "
    "WHEN 'P' THEN 'WITHDRAWN' END",
    "first_condition": _choose(
        (
            "Lung Cancer",
            "Breast Cancer",
            "Diabetes",
            "Hypertension",
            "Heart Failure",
            "Depression",
            "Asthma",
        ),
        "o_custkey % 7",
    ),
    "second_condition": "'group ' || repeat(o_orderpriority || ' ', 8)",
    "has_conditions": "o_orderkey % 8 <> 0",
    "drug_count": "CAST(o_orderkey % 6 AS INT)",
    "phase": _text("1 + o_custkey % 4"),
    "enrolled": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END",
    "sponsor": f"CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'Sponsor ' || {_text('o_custkey % 40')} END",
}


def trials(spark: SparkSession, folder: str) -> DataFrame:
    flat = table(spark, folder, "orders").selectExpr(*_values(_TRIAL_COLUMNS))
    agents = [
        "named_struct('name', '" + ("" if i % 3 == 0 else f"agent-{i}") + "')"
        for i in range(1, 6)
    ]
    return flat.selectExpr(
        "source_pos",
        "named_struct("
        "'identificationModule', named_struct('nctId', nct_id, 'briefTitle', title), "
        "'statusModule', named_struct('overallStatus', status), "
        "'conditionsModule', named_struct('conditions', "
        "if(has_conditions, array(first_condition, second_condition), NULL)), "
        "'armsInterventionsModule', named_struct('interventions', "
        f"{_first_of(agents, 'drug_count')}), "
        "'designModule', named_struct('phases', array('PHASE' || phase, 'EXTENSION'), "
        "'enrollmentInfo', named_struct('count', enrolled)), "
        "'sponsorCollaboratorsModule', named_struct('leadSponsor', "
        "named_struct('name', sponsor))) AS protocolSection",
    )


TRIALS_SQL = _select(_TRIAL_COLUMNS, "orders")

# --- customers as drug labels ------------------------------------------------

LABEL_DRUGS = (
    "warfarin",
    "insulin",
    "digoxin",
    "metformin",
    "nivolumab",
    "aspirin",
    "sertraline",
    "Warfarin",
)
LABEL_CATEGORIES = (
    "high_risk_drugs",
    "oncology_drugs",
    "cardiac_drugs",
    "psychiatric_drugs",
)
_LABEL_COLUMNS = {
    "source_pos": "c_custkey",
    "setid": "CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN '' "
    f"ELSE 'set-' || {_text('c_custkey')} END",
    "drug_name": _choose(LABEL_DRUGS, "c_custkey % 8"),
    "category": _choose(LABEL_CATEGORIES, "c_custkey % 4"),
}


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*_values(_LABEL_COLUMNS))


LABELS_SQL = _select(_LABEL_COLUMNS, "customer")

# --- parts as canonical records for the corpus -------------------------------


def _sometimes(word: str, shift: int) -> str:
    """Null for a quarter of the rows, blank for another, else a text."""
    index = f"(p_partkey + {shift}) % 4"
    return (
        f"CASE {index} WHEN 0 THEN NULL WHEN 1 THEN '' "
        f"ELSE '{word} ' || {_text('p_size')} END"
    )


_RECORD_COLUMNS = {
    "p_partkey": "p_partkey",
    "drug_name": "CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name "
    "WHEN 2 THEN '' END",
    "device_name": "CASE p_partkey % 5 WHEN 2 THEN p_name || ' (' || p_brand || ')' "
    "WHEN 3 THEN p_brand || ' monitor' END",
    "condition": "CASE p_partkey % 10 WHEN 4 THEN p_type WHEN 0 THEN p_type "
    "WHEN 9 THEN '' END",
    "old_dosage": _sometimes("dose", 0),
    "new_dosage": _sometimes("reduced dose", 1),
    "old_warning": _sometimes("watch level", 2),
    "new_warning": _sometimes("watch closely level", 3),
    "old_indication": _sometimes("use class", 1),
    "new_indication": _sometimes("narrow use class", 2),
    "recall_reason": "CASE WHEN p_partkey % 3 = 0 THEN 'Fault ' || p_type ELSE '' END",
    "risk_level": "CASE WHEN p_size > 40 THEN 'Critical' WHEN p_size > 25 THEN 'High' "
    "WHEN p_size > 2 THEN 'Medium' END",
    "fda_approval_date": _sometimes("approved in year", 3),
    "clinical_trial_id": _sometimes("NCT", 2),
    "patient_population": _sometimes("cohort", 1),
    "contraindications": _sometimes("contraindication", 0),
    "adverse_events": _sometimes("effect", 3),
    "mechanism_of_action": _sometimes("mechanism", 2),
    "therapeutic_class": _sometimes("class", 1),
    "manufacturer": "p_brand",
    "regulatory_status": _sometimes("status", 0),
    "clinical_significance": _sometimes("significance", 3),
    "patient_safety_impact": _sometimes("impact", 2),
    "compliance_deadline": _sometimes("deadline", 1),
    "update_date": _sometimes("updated in week", 3),
}


def records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(*_values(_RECORD_COLUMNS))


RECORDS_SQL = _select(_RECORD_COLUMNS, "part")

# --- orders with date texts --------------------------------------------------


def _date_texts(full: str, short: str) -> str:
    return (
        f"CASE WHEN o_orderkey % 11 = 0 THEN ' ' WHEN o_orderkey % 7 = 0 THEN {short} "
        f"ELSE {full} END"
    )


def dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    text = _date_texts(
        "date_format(o_orderdate, 'M/d/yyyy')", "date_format(o_orderdate, 'M/d/yy')"
    )
    return table(spark, folder, "orders").selectExpr("o_orderkey", f"{text} AS Date")


DATED_ORDERS_SQL = (
    "SELECT o_orderkey, "
    + _date_texts(
        "strftime(o_orderdate, '%-m/%-d/%Y')", "strftime(o_orderdate, '%-m/%-d/%y')"
    )
    + " AS date_text FROM orders"
)
