"""Every operator as a query over whole tables. Dates are shown as text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom import schemas
from alertloom.fixed import documents as fixed_documents
from alertloom.functions import codes, dates, nested, seeded, text
from alertloom.operators import (
    clean,
    corpus,
    flatten,
    generate,
    harvest,
    impact,
    match,
    normalize,
    quality,
    sample,
    scenario,
)
from alertloom.plans import alerts
from alertloom.plans import harvest as harvest_plan
from alertloom.queries import inputs
from alertloom.queries.backends import backend_factory
from alertloom.queries.inputs import AS_OF, SEED, table
from alertloom.session import scratch_path, settle_alone
from alertloom.sources import keys, phrases, readers, sinks, snapshots
from alertloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOADED_AT = dt.datetime.fromisoformat(inputs.LOADED_AT)
STAMP = "yyyy-MM-dd HH:mm:ss"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- readiness ---------------------------------------------------------------


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: table(spark, folder, name) for name in inputs.TABLES}
    return quality.table_counts(spark, {**tables, inputs.ABSENT: None})


@query
def table_readiness(spark, folder):
    return _counts(spark, folder)


@query
def readiness_summary(spark, folder):
    return quality.readiness_summary(_counts(spark, folder))


# --- scenarios ---------------------------------------------------------------


@query
def scenario_entity(spark, folder):
    return scenario.with_entity(inputs.scenarios(spark, folder)).select(
        "scenario_id", "clinical_entity", "entity_type"
    )


@query
def critical_scenarios(spark, folder):
    return scenario.critical(inputs.scenarios(spark, folder), ["scenario_id"])


@query
def scenario_previews(spark, folder):
    return scenario.previews(inputs.scenarios(spark, folder), ["scenario_id"])


@query
def latest_alert(spark, folder):
    events = table(spark, folder, "events")
    notices = events.select(
        "event_id",
        F.concat_ws(" ", "event_type", "props").alias("Safety Alert"),
        F.col("event_type").alias("Product Type"),
        F.when(F.col("event_id") % 5 != 0, F.col("ts").cast("date")).alias("alert_date"),
    )
    newest = sample.latest(notices, F.col("alert_date"), [F.col("event_id")])
    named = clean.plain_column_names(
        newest.select("`Safety Alert`", "`Product Type`", "alert_date")
    )
    return named.withColumn("alert_date", dates.iso(F.col("alert_date")))


@query
def scenario_pick(spark, folder):
    scenarios = scenario.critical(inputs.scenarios(spark, folder), ["scenario_id"])
    return scenario.select_scenario(scenarios, ["scenario_id"], SEED)


@query
def scenario_fallback(spark, folder):
    """No record has this risk, so the fixed scenario comes back."""
    scenarios = scenario.critical(inputs.scenarios(spark, folder), ["scenario_id"])
    none = scenarios.filter(F.col("manufacturer") == "nobody")
    return scenario.select_scenario(none, ["scenario_id"], SEED)


# --- answers and metrics -----------------------------------------------------


def _critical(spark: SparkSession, folder: str) -> DataFrame:
    return scenario.critical(inputs.scenarios(spark, folder), ["scenario_id"])


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    return scenario.with_entity(inputs.scenarios(spark, folder))


@query
def briefing_default(spark, folder):
    return _entities(spark, folder).select(
        "scenario_id", generate.default_briefing().alias("briefing")
    )


@query
def financial_estimate(spark, folder):
    return inputs.scenarios(spark, folder).select(
        "scenario_id", "risk_level", generate.default_cost().alias("financial_impact")
    )


@query
def generated_number(spark, folder):
    answer = (
        F.when(F.col("scenario_id") % 6 == 0, F.lit(None).cast("string"))
        .when(F.col("scenario_id") % 6 == 1, "0")
        .when(F.col("scenario_id") % 6 == 2, "about a million")
        .when(F.col("scenario_id") % 6 == 3, "250000.5")
        .otherwise(F.col("scenario_id").cast("string"))
    )
    return inputs.scenarios(spark, folder).select(
        "scenario_id",
        generate.number_or(answer, generate.default_cost()).alias("financial_impact"),
    )


@query
def cost_breakdown(spark, folder):
    priced = inputs.scenarios(spark, folder).withColumn(
        "financial_impact", generate.default_cost()
    )
    return generate.cost_breakdown(priced, ["scenario_id"]).withColumn(
        "share_percent", F.col("share_percent").cast("bigint")
    )


@query
def action_plan(spark, folder):
    planned = _critical(spark, folder).withColumn("plan", generate.default_plan())
    return generate.plan_rows(planned, ["scenario_id"])


@query
def plan_hours(spark, folder):
    scenarios = inputs.scenarios(spark, folder)
    steps = generate.plan_rows(
        scenarios.withColumn("plan", generate.default_plan()), ["scenario_id"]
    )
    kept = steps.filter(F.col("estimated_hours") % 5 < F.col("scenario_id") % 5)
    hours = impact.plan_hours(scenarios, kept, ["scenario_id"])
    return hours.select("scenario_id", impact.HOURS)


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    effort = inputs.scenarios(spark, folder).select(
        "scenario_id",
        F.col("k").alias(impact.HOURS),
        generate.default_cost().alias(impact.COST),
    )
    return impact.impact_metrics(effort)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query
def impact_metrics(spark, folder):
    return _rounded(_measured(spark, folder), "efficiency_gain", "speed_up")


@query
def impact_comparison(spark, folder):
    rows = impact.impact_comparison(_measured(spark, folder), ["scenario_id"])
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query
def stat_tiles(spark, folder):
    return impact.stat_tiles(_measured(spark, folder), ["scenario_id"])


@query
def annual_projection(spark, folder):
    rows = impact.annual_projection(_measured(spark, folder), ["scenario_id"])
    return _rounded(rows, "annual_millions").withColumn(
        "alerts_per_year", F.col("alerts_per_year").cast("bigint")
    )


@query
def alert_analysis(spark, folder):
    """The flagship: every critical scenario from record to metrics."""
    analyzed = alerts.analyze(inputs.scenarios(spark, folder), ["scenario_id"])
    return _rounded(analyzed, "efficiency_gain", "speed_up").select(
        "scenario_id",
        "clinical_entity",
        "risk_level",
        "compliance_deadline",
        "briefing",
        "financial_impact",
        "total_hours",
        "time_saved",
        "efficiency_gain",
        "cost_saved",
        "speed_up",
    )


# --- cleaning ----------------------------------------------------------------


@query
def parse_date_coerce(spark, folder):
    orders = clean.add_date(inputs.dated_orders(spark, folder), "Date", "alert_date")
    return orders.select(
        "o_orderkey",
        F.col("Date").alias("date_text"),
        dates.iso(F.col("alert_date")).alias("alert_date"),
    )


@query
def stamp_provenance(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(" o_orderkey "),
        F.col("o_orderpriority").alias("o_orderpriority  "),
        F.lit(None).cast("string").alias("_c2"),
    )
    cleaned = clean.drop_blank_columns(clean.trim_column_names(orders))
    stamped = clean.stamp(cleaned, LOADED_AT, "orders")
    return stamped.withColumn("processed_at", F.date_format("processed_at", STAMP))


@query
def text_cast_nulls(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return clean.text_columns(orders, "nan")


@query
def field_fallback(spark, folder):
    records = inputs.records(spark, folder)
    chained = text.first_filled(
        [F.col("drug_name"), F.col("device_name")], F.col("condition"), "Clinical Update"
    )
    return records.select("p_partkey", chained.alias("subject"))


CUSTOM_RULES = (
    (("ring", "rod"), "ROUND"),
    (("RED", "small"), "MARKED"),
    (("g",), "HAS_G"),
)


@query
def keyword_class(spark, folder):
    name = F.col("p_name")
    suffix = seeded.choice(
        (" SOP.txt", " training.txt", " Device.pdf", " guidance.pdf", " notes.txt"),
        F.col("p_partkey"),
        seed=SEED,
    )
    return table(spark, folder, "part").select(
        "p_partkey",
        text.keyword_class(name, CUSTOM_RULES, "OTHER").alias("custom_class"),
        text.keyword_class(
            F.concat(name, suffix),
            clean.codes.DOCUMENT_RULES,
            clean.codes.DOCUMENT_DEFAULT,
        ).alias("document_type"),
    )


@query
def document_manifest(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "").alias(
            "relative_path"
        ),
        F.octet_length("html").alias("length"),
    )
    named = pages.withColumn(
        "relative_path",
        F.concat(
            "relative_path",
            F.when(F.col("length") % 5 == 0, "/memo.html")
            .when(F.col("length") % 5 == 1, "/.hidden.html")
            .when(F.col("length") % 5 == 2, "/draft.tmp")
            .when(F.col("length") % 5 == 3, "/Device_Manual.v2.pdf")
            .otherwise("/readme"),
        ),
    )
    manifest = clean.document_manifest(named, "store://bucket", LOADED_AT)
    return manifest.withColumn(
        "upload_timestamp", F.date_format("upload_timestamp", STAMP)
    )


@query
def code_labels(spark, folder):
    code = (F.col("l_partkey") % 8).cast("string")
    kinds = (
        "qualification",
        "outcome",
        "reporttype",
        "actiondrug",
        "drugcharacterization",
        "no_such_map",
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[codes.label(code, kind).alias(kind) for kind in kinds],
    )


@query
def lookup_join(spark, folder):
    """Codes labelled from a table that lacks some of them."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", (F.col("l_suppkey") % 30).alias("code")
    )
    nations = table(spark, folder, "nation")
    return clean.lookup_table(lines, "code", nations, "n_nationkey", "n_name", "label")


@query
def flag_labels(spark, folder):
    reports = inputs.reports(spark, folder)
    return reports.select(
        "source_pos",
        codes.yes_no(F.col("fulfillexpeditecriteria")).alias("expedited"),
        codes.sex(F.col("patient.patientsex")).alias("sex"),
    )


def _json_document() -> Column:
    return F.concat(
        F.lit('{"a":{"list":[{"c":"'),
        F.col("user_id").cast("string"),
        F.lit('"},{"c":""},{"c":null}]},"props":'),
        F.col("props"),
        F.lit("}"),
    )


@query
def json_path_default(spark, folder):
    document = _json_document()

    def at(path: str) -> Column:
        return nested.json_value(document, path, "default")

    return table(spark, folder, "events").select(
        "event_id",
        at("props.k").alias("k"),
        at("props.z").alias("absent"),
        at("a.list.0.c").alias("first"),
        at("a.list.1.c").alias("blank"),
        at("a.list.2.c").alias("null_value"),
        at("a.list.9.c").alias("beyond"),
        at("a.x.y").alias("broken"),
    )


ROW_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "code")


@query
def row_id(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        *ROW_KEY[:4],
        F.nullif("l_returnflag", F.lit("N")).alias("code"),
    )
    return clean.add_row_id(lines, ROW_KEY)


# --- reports and records -----------------------------------------------------


@query
def adverse_flatten(spark, folder):
    return flatten.flatten_adverse_events(inputs.reports(spark, folder))


@query
def explode_reports(spark, folder):
    """Reaction arrays exploded with positions; a report without any gives no row."""
    reports = inputs.reports(spark, folder).select(
        F.col("source_pos").alias("report"), F.col("patient.reaction").alias("results")
    )
    return flatten.explode_reports(reports).withColumn(
        "source_pos", F.col("source_pos").cast("bigint")
    )


@query
def risk_seriousness(spark, folder):
    return inputs.reports(spark, folder).select(
        "source_pos",
        codes.risk_by_seriousness(F.col("serious"), F.col("seriousnessother")).alias(
            "risk_level"
        ),
    )


@query
def risk_recall_class(spark, folder):
    grade = F.col("classification")
    return inputs.recalls(spark, folder).select(
        "source_pos",
        codes.recall_class(grade).alias("recall_class"),
        codes.risk_by_recall_class(grade).alias("risk_level"),
    )


@query
def deadlines(spark, folder):
    start = F.col("o_orderdate").cast("date")
    seeded_days = seeded.integer_between(14, 60, F.col("o_orderkey"), seed=SEED)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.deadline(start, 30).alias("in_30"),
        dates.deadline(start, 90).alias("in_90"),
        dates.deadline(start, seeded_days.cast("int")).alias("in_seeded"),
    )


@query
def normalize_trials(spark, folder):
    keyed = harvest.keyed_only(inputs.trials(spark, folder), normalize.trial_url())
    return normalize.normalize_trials(keyed, AS_OF)


@query
def normalize_events(spark, folder):
    return normalize.normalize_events(inputs.reports(spark, folder), AS_OF)


@query
def normalize_recalls(spark, folder):
    return normalize.normalize_recalls(inputs.recalls(spark, folder), AS_OF)


@query
def normalize_labels(spark, folder):
    keyed = harvest.keyed_only(inputs.labels(spark, folder), F.col("setid"))
    return normalize.normalize_labels(keyed, AS_OF, SEED)


# --- taking in ---------------------------------------------------------------


def _terms(matched: DataFrame, *columns: str) -> DataFrame:
    return matched.select(*columns, "term", "term_rank")


@query
def terms_trials(spark, folder):
    return _terms(harvest.match_trials(inputs.trials(spark, folder)), "source_pos")


@query
def terms_events(spark, folder):
    reports = inputs.reports(spark, folder)
    return _terms(harvest.match_events(reports), "source_pos", "safetyreportid")


@query
def terms_recalls(spark, folder):
    return _terms(harvest.match_recalls(inputs.recalls(spark, folder)), "source_pos")


@query
def terms_labels(spark, folder):
    matched = harvest.match_labels(inputs.labels(spark, folder))
    return _terms(matched, "source_pos", "category")


@query
def terms_table(spark, folder):
    """Words of part names that a table of terms lists, some of them repeatedly."""
    words = F.array(*[F.lit(w) for w in inputs.TERM_WORDS])
    terms = table(spark, folder, "supplier").select(
        F.get(words, (F.col("s_suppkey") % len(inputs.TERM_WORDS)).cast("int")).alias(
            "term"
        ),
        F.col("s_suppkey").alias("term_rank"),
    )
    matched = harvest.match_term_table(
        table(spark, folder, "part"), F.split("p_name", " "), terms
    )
    return _terms(matched, "p_partkey")


@query
def keyed_only(spark, folder):
    labels = inputs.labels(spark, folder)
    return harvest.keyed_only(labels, F.col("setid")).select("source_pos", "setid")


@query
def cap_per_term(spark, folder):
    feed = inputs.feed(spark, folder)
    return harvest.cap_per_group(feed, ["term"], ["source_pos"], 12).select(
        "term", "source_pos", "source_url"
    )


def _seen(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("k") < inputs.SEEN_BELOW).select("source_url").distinct()


@query
def new_only(spark, folder):
    feed = inputs.feed(spark, folder)
    return harvest.new_only(feed, _seen(feed)).select("source_pos", "source_url")


def _firsts(spark: SparkSession, folder: str) -> DataFrame:
    feed = inputs.feed(spark, folder)
    return harvest.first_wins(feed, [F.col("source_rank"), F.col("source_pos")])


@query
def first_wins(spark, folder):
    return _firsts(spark, folder).select("source_url", "source", "source_pos")


@query
def source_counts(spark, folder):
    feed = inputs.feed(spark, folder)
    return harvest.source_counts(
        harvest.new_only(_firsts(spark, folder), _seen(feed))
    )


@query
def seen_state(spark, folder):
    feed = inputs.feed(spark, folder)
    lines = feed.select(F.concat(F.lit("  "), "source_url", F.lit(" ")).alias("value"))
    return harvest.merge_keys(_seen(feed), harvest.clean_keys(lines))


@query
def union_sources(spark, folder):
    recalls = inputs.recalls(spark, folder).select(
        "source_pos", F.col("recall_number").alias("key"), "recalling_firm"
    )
    labels = inputs.labels(spark, folder).select(
        "source_pos", F.col("setid").alias("key"), "drug_name"
    )
    stacked = harvest.union_sources([("labels", labels), ("recalls", recalls)])
    return stacked.withColumn("source_rank", F.col("source_rank").cast("bigint"))


@query
def demo_topup(spark, folder):
    """Enough records: none added. Forced: the two fixed records are added."""
    records = normalize.normalize_recalls(inputs.recalls(spark, folder), AS_OF)
    extra = harvest_plan.demo_records(records, AS_OF)
    plenty = harvest.top_up(records, extra).withColumn("run", F.lit("plenty"))
    few = records.filter(F.col("manufacturer") == "nobody")
    short = harvest.top_up(few, extra).withColumn("run", F.lit("short"))
    forced = harvest.top_up(records, extra, force=True).withColumn("run", F.lit("forced"))
    stacked = plenty.unionByName(short).unionByName(forced)
    return stacked.groupBy("run", "therapeutic_class").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("adverse_event_count").alias("events"),
    )


@query
def sample_exact_n(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return sample.sample_exact(orders, 1000, ["o_orderkey"], SEED)


@query
def sample_exact_large(spark, folder):
    """Three thousand line items, on a key of two columns."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return sample.sample_exact(lines, 3000, ["l_orderkey", "l_linenumber"], SEED)


def _landed(spark: SparkSession, folder: str) -> harvest_plan.Landed:
    return harvest_plan.Landed(
        labels=inputs.labels(spark, folder),
        events=inputs.reports(spark, folder),
        recalls=inputs.recalls(spark, folder),
        trials=inputs.trials(spark, folder),
    )


@query
def harvest_records(spark, folder):
    """All four sources with the page limits: first per key, not seen before, capped per term."""
    seen = inputs.recalls(spark, folder).select(normalize.recall_url().alias("source_url"))
    seen = seen.filter(seeded.hash_int(F.col("source_url"), seed=SEED) % 2 == 0)
    caps = harvest_plan.PAGE_CAPS
    new = harvest_plan.new_records(_landed(spark, folder), seen, AS_OF, SEED, caps)
    return new.select("source", *harvest_plan.table_columns(new))


@query
def harvest_uncapped(spark, folder):
    """Every matched record of every source, for every term."""
    new = harvest_plan.new_records(_landed(spark, folder), None, AS_OF, SEED)
    return new.select("source", *harvest_plan.table_columns(new))


@query
def harvest_rounds(spark, folder):
    """Capped runs over the same landing until nothing is new: in the end all of it."""
    landed, taken = _landed(spark, folder), None
    most = landed.events.count() + landed.recalls.count() + landed.trials.count()
    caps = harvest_plan.Caps(*[1 + most // 8] * 4)
    while True:
        seen = taken.select("source_url") if taken is not None else None
        new = settle_alone(lambda: harvest_plan.new_records(landed, seen, AS_OF, SEED, caps), "round")
        if new.isEmpty():
            return taken.select("source", *harvest_plan.table_columns(taken))
        taken = new if taken is None else taken.unionByName(new)


@query
def cap_large(spark, folder):
    """A cap above what Spark cuts before a shuffle by itself."""
    feed = inputs.feed(spark, folder)
    return harvest.cap_per_group(feed, ["term"], ["source_pos"], 1500).select(
        "term", "source_pos", "source_url"
    )


# --- corpus ------------------------------------------------------------------


def _keys() -> list[Column]:
    return [F.col("p_partkey")]


@query
def template_route(spark, folder):
    return inputs.records(spark, folder).select(
        "p_partkey", corpus.route(_keys(), SEED).alias("template")
    )


@query
def seeded_values(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        seeded.integer_between(
            30, 1825, F.col("l_orderkey"), F.col("l_linenumber"), seed=SEED
        ).alias("days"),
        seeded.choice(
            ("a", "b", "c"), F.col("l_orderkey"), F.col("l_partkey"), seed=SEED
        ).alias("choice"),
        seeded.happens(0.2, F.col("l_orderkey"), seed=SEED).alias("sampled"),
    )


@query
def render_memo(spark, folder):
    return inputs.records(spark, folder).select(
        "p_partkey", corpus.training_memo(_keys(), AS_OF, SEED).alias("text")
    )


@query
def render_alert(spark, folder):
    return inputs.records(spark, folder).select(
        "p_partkey", corpus.safety_alert(_keys(), AS_OF, SEED).alias("text")
    )


@query
def render_summary(spark, folder):
    return inputs.records(spark, folder).select(
        "p_partkey", corpus.research_summary(_keys(), AS_OF, SEED).alias("text")
    )


@query
def render_pages(spark, folder):
    """The five documents that are laid out on pages, as text, each for every record."""
    keys = _keys()
    return inputs.records(spark, folder).select(
        "p_partkey",
        corpus.medication_protocol(keys, AS_OF, SEED).alias("medication_protocol"),
        corpus.medication_protocol(keys, AS_OF, SEED, "formulary_entry").alias("formulary_entry"),
        corpus.device_manual(keys, AS_OF, SEED).alias("device_manual"),
        corpus.clinical_guideline(keys, AS_OF, SEED).alias("clinical_guideline"),
        corpus.nursing_protocol(keys, AS_OF, SEED).alias("nursing_protocol"),
    )


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.documents(
        inputs.records(spark, folder), ["p_partkey"], AS_OF, 5, SEED
    )


@query
def corpus_file_name(spark, folder):
    return _documents(spark, folder).select(
        "p_partkey", "format", "file_name", "image_name"
    )


@query
def corpus_documents(spark, folder):
    return _documents(spark, folder).select(
        "p_partkey", "template", "file_name", "text", "has_image"
    )


@query
def corpus_stats(spark, folder):
    return corpus.corpus_stats(_documents(spark, folder))


@query
def corpus_fields(spark, folder):
    documents = _documents(spark, folder).filter(
        F.col("template").isin(
            *[n for n, spec in fixed_documents.TEMPLATES.items() if spec[1] == "txt"]
        )
    )
    fields = match.corpus_fields(documents, "p_partkey")
    return fields.select(
        "p_partkey",
        "title",
        "risk_level",
        "document_number",
        "sections",
        F.get("extracted_entities", F.lit(0))["entity_value"].alias("subject"),
    )


# --- files: what is written is read again ------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


@query
def csv_roundtrip(spark, folder):
    """Event files of two layouts, with their columns in other orders, and a strange file."""
    path = _folder(spark, "csv")
    flat = flatten.flatten_adverse_events(inputs.reports(spark, folder))
    backwards = list(reversed(flat.columns))
    fewer = sorted(c for c in flat.columns if c != "drugindication")
    known = F.col("occurcountry").isNotNull()
    sinks.write_csv(flat.filter(known), f"{path}/drug-event-1.csv", backwards)
    sinks.write_csv(flat.filter(~known), f"{path}/drug-event-2.csv", fewer)
    regions = table(spark, folder, "region")
    sinks.write_csv(regions, f"{path}/drug-event-3.csv", regions.columns)
    return readers.read_event_csv(spark, path, skip_unknown=True)


@query
def csv_line_breaks(spark, folder):
    """Event files with line breaks and quotes in their values, written and read."""
    path = _folder(spark, "csv-line-breaks")
    flat = flatten.flatten_adverse_events(inputs.reports(spark, folder))
    broken = F.concat("reactions", F.lit('\r\n"a",\n'), "safetyreportid")
    sinks.write_events(flat.withColumn("reactions", broken), f"{path}/drug-event-1.csv")
    return readers.read_event_csv(spark, path)


@query
def landed_lines(spark, folder):
    """Reports landed as JSON lines, packed and in files of bounded length, flattened."""
    path = _folder(spark, "lines")
    reports = inputs.reports(spark, folder).drop("source_pos")
    sinks.write_lines(reports, path)
    landed = readers.read_landed_lines(spark, path, schemas.EVENT_REPORT)
    return flatten.flatten_adverse_events(landed)


RESPONSE_RECORDS = 200


@query
def landed_responses(spark, folder):
    """Recalls landed in responses, one file each, with their position there."""
    path = _folder(spark, "responses")
    recalls = inputs.recalls(spark, folder)
    page = F.floor(F.col("source_pos") / RESPONSE_RECORDS).alias("page")
    record = F.struct("source_pos", *schemas.DEVICE_RECALL.names)
    responses = recalls.groupBy(page).agg(F.sort_array(F.collect_list(record)).alias("results"))
    responses.select("results").write.option("maxRecordsPerFile", 1).json(path)
    landed = readers.read_landed(spark, path, schemas.DEVICE_RECALL)
    return landed.withColumn("source_pos", F.col("source_pos").cast("bigint")).drop("source_file")


@query
def newest_records(spark, folder):
    """Two record files; the newer one by the time in its name is read."""
    path = _folder(spark, "records")
    records = normalize.normalize_recalls(inputs.recalls(spark, folder), AS_OF)
    sinks.write_records(records, f"{path}/clinical_ground_truth_2025-02-01_000000.csv")
    older = records.filter(F.col("risk_level") == "High")
    sinks.write_records(older, f"{path}/clinical_ground_truth_2025-01-01_000000.csv")
    return readers.read_records(spark, path)


@query
def key_state_files(spark, folder):
    """Keys added to the state by two runs that overlap."""
    path = _folder(spark, "seen")
    feed = inputs.feed(spark, folder)
    sinks.append_seen(_seen(feed), path)
    sinks.append_seen(feed, path)
    return readers.read_seen(spark, path)


@query
def key_store_rounds(spark, folder):
    """Ten runs that overlap, each adding what no earlier run has seen; the run that a key came with."""
    root = scratch_path(spark, "rounds")
    rows = table(spark, folder, "events").select("event_id", F.col("user_id").alias("key"))
    firsts = rows.groupBy(F.pmod("event_id", F.lit(10)).alias("run"), "key").agg(F.min("event_id").alias("event_id"))
    for number in range(10):
        own = firsts.filter(F.col("run") == number).select("key", "event_id", "run")
        held = keys.commit_new(own, root, "key", batch=number)
    return held.read(spark, "data", own.schema)


@query
def atomic_commit(spark, folder):
    """Two loads of orders that overlap; the second fails before its keys are written, and is repeated."""
    root = scratch_path(spark, "commits")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    numbered = orders.withColumn("load", F.lit(1))
    first = keys.commit_new(numbered.filter("o_orderkey % 3 < 2"), root, "o_orderkey", batch=1)
    again = orders.withColumn("load", F.lit(2)).filter("o_orderkey % 3 > 0")
    snapshots.stage(first, "data", again.write.parquet)  # the failed attempt: no version names it
    keys.commit_new(again, root, "o_orderkey", batch=2)
    keys.commit_new(again, root, "o_orderkey", batch=2)
    return snapshots.snapshot(spark, root).read(spark, "data", numbered.schema)


@query
def table_writes(spark, folder):
    """A table replaced by itself, then appended to, then given the keys it lacks."""
    path = f"{_folder(spark, 'tables')}/orders"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")

    def step(name: str, third: int | None = None) -> DataFrame:
        chosen = orders if third is None else orders.filter(F.col("o_orderkey") % 3 == third)
        return chosen.withColumn("step", F.lit(name))

    sinks.replace_table(step("first", 0), path)
    sinks.replace_table(step("replaced", 0), path)
    sinks.append_table(step("appended", 1), path)
    sinks.append_new(step("new"), path, "o_orderkey")
    return readers.read_table(spark, path)


@query
def file_listing(spark, folder):
    """Bytes of the files of each folder, from the listing."""
    path = _folder(spark, "files")
    pages = table(spark, folder, "pages").filter(F.col("html").isNotNull())
    pages.select("html", (F.col("page_id") % 4).alias("part")).write.partitionBy("part").text(path)
    listed = readers.list_documents(spark, path)
    return listed.groupBy(F.substring_index("relative_path", "/", 1).alias("part")).agg(
        F.sum("length").alias("bytes")
    )


@query
def row_audits(spark, folder):
    """Rows counted while tables are written, beside those that are read back."""
    path = _folder(spark, "audits")
    counts = []
    for name in ("orders", "lineitem"):
        audited, observation = quality.audited(table(spark, folder, name), name)
        sinks.replace_table(audited, f"{path}/{name}")
        written = readers.read_table(spark, f"{path}/{name}")
        counts.append(
            written.agg(
                F.lit(name).alias("table_name"),
                F.lit(observation.get["rows"]).cast("bigint").alias("audited"),
                F.count(F.lit(1)).alias("written"),
            )
        )
    return counts[0].unionByName(counts[1])


@query
def corpus_table(spark, folder):
    """The corpus as it is stored."""
    path = _folder(spark, "corpus")
    sinks.write_corpus(_documents(spark, folder), path)
    return readers.read_table(spark, path)


# --- generation --------------------------------------------------------------


@query
def prompt_text(spark, folder):
    return _entities(spark, folder).select(
        "scenario_id",
        generate.briefing_prompt().alias("briefing_prompt"),
        generate.cost_prompt().alias("cost_prompt"),
        generate.plan_prompt(
            generate.default_briefing(), generate.default_cost()
        ).alias("plan_prompt"),
    )


@query
def response_unpack(spark, folder):
    body = '{"candidates":[{"content":{"parts":[{"text":"note '
    number = F.col("scenario_id").cast("string")
    case = F.col("scenario_id") % 6
    response = (
        F.when(case == 0, F.concat(F.lit(body), number, F.lit('"}]}}]}')))
        .when(
            case == 1,
            F.concat(F.lit(body), number, F.lit('"}]},"finish_reason":"MAX_TOKENS"}]}')),
        )
        .when(
            case == 2,
            F.concat(F.lit(body), number, F.lit('"}]},"finish_reason":"STOP"}]}')),
        )
        .when(case == 3, "oops")
        .when(case == 4, '{"candidates":[]}')
    )
    parts = generate.unpack_response(response)
    return _entities(spark, folder).select(
        "scenario_id",
        F.coalesce(parts["generated_text"], generate.default_briefing()).alias("briefing"),
        parts["finish_reason"].alias("finish_reason"),
        parts["is_truncated"].alias("is_truncated"),
    )


@query
def generate_text_batch(spark, folder):
    answered = generate.generate_text(
        _entities(spark, folder),
        generate.briefing_prompt(),
        backend_factory("text"),
        generate.default_briefing(),
    )
    return answered.select("scenario_id", "briefing", "finish_reason", "is_truncated")


@query
def generate_double_batch(spark, folder):
    answered = generate.generate_double(
        _entities(spark, folder),
        generate.cost_prompt(),
        backend_factory("number"),
        generate.default_cost(),
    )
    return answered.select("scenario_id", "financial_impact")


@query
def generate_table_batch(spark, folder):
    answered = generate.generate_table(
        _entities(spark, folder),
        generate.cost_prompt(),
        backend_factory("table"),
        fallback=generate.default_plan(),
    )
    return generate.plan_rows(answered, ["scenario_id"])


@query
def alert_analysis_backend(spark, folder):
    """The analysis with generated answers, from a backend that fails at times."""
    analyzed = alerts.analyze_with_backend(
        inputs.scenarios(spark, folder), ["scenario_id"], backend_factory(raises=True)
    )
    return _rounded(analyzed, "efficiency_gain", "speed_up").select(
        "scenario_id",
        "briefing",
        "finish_reason",
        "is_truncated",
        "financial_impact",
        F.size("plan").cast("bigint").alias("steps"),
        "total_hours",
        "time_saved",
        "efficiency_gain",
        "cost_saved",
        "speed_up",
        F.col("failed_calls").cast("bigint").alias("failed_calls"),
    )


# --- streaming ---------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    stream = ingest.read_landed_stream(spark, folder, schema, "events.parquet")
    return stream.select(
        "event_id",
        F.concat_ws("/", F.lit("https://records.invalid"), "user_id", "props").alias(
            "source_url"
        ),
        F.col("ts").cast("timestamp").alias("landed_at"),
    )


@query
def stream_new_only(spark, folder):
    """Each key once. Which copy stays depends on arrival, so only keys are shown."""
    paths = ingest.scratch(spark, "stream-new")
    fresh = ingest.new_records(_event_stream(spark, folder))
    ingest.run_to_table(fresh, paths["data"], paths["state"])
    return spark.read.parquet(paths["data"]).select("source_url")


@query
def stream_to_table(spark, folder):
    """First record of each key, in order of event id, with the keys in a table."""
    paths = ingest.scratch(spark, "stream-table")
    stream = _event_stream(spark, folder).drop("landed_at")
    ingest.stream_to_table(stream, paths["data"], paths["state"], order=[F.col("event_id")])
    return ingest.read_streamed(spark, paths["data"], stream.schema).select("source_url", "event_id")


# --- matching ----------------------------------------------------------------


@query
def affected_documents(spark, folder):
    """Benchmark passages, their opening words and part names, found in documents."""
    opening = match.plain_words(F.col("text"))
    probes = table(spark, folder, "benchmark").select(
        F.explode(
            F.array(
                F.substring_index(opening, " ", 2),
                F.substring_index(opening, " ", 6),
                opening,
            )
        ).alias("clinical_entity")
    )
    names = table(spark, folder, "part").select(
        match.plain_words(F.col("p_name")).alias("clinical_entity")
    )
    probes = probes.unionByName(names)
    return match.affected_documents(probes, table(spark, folder, "documents"))


def _probes(spark: SparkSession, folder: str) -> DataFrame:
    """Opening words of benchmark passages, of any number."""
    opening = match.plain_words(F.col("text"))
    lengths = F.array(F.lit(1), F.lit(2), F.lit(4), F.lit(9))
    cut = F.transform(lengths, lambda n: F.array_join(F.slice(F.split(opening, " "), 1, n), " "))
    return table(spark, folder, "benchmark").select(F.explode(F.array_append(cut, opening)).alias("clinical_entity"))


@query
def phrase_index(spark, folder):
    """Passages found from an index to which documents are added in three runs, some of them changed since."""
    root = scratch_path(spark, "phrase-index")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    old = docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.upper(F.reverse("text"))).otherwise(F.col("text")))
    phrases.add(old.filter("doc_id % 3 < 2"), root)
    phrases.add(docs.filter("doc_id % 3 = 2"), root)
    phrases.add(docs.filter("doc_id % 5 = 0"), root)
    held = phrases.remove(docs.filter("doc_id % 7 = 0"), root)
    found = phrases.find(_probes(spark, folder), held, docs.schema["doc_id"])
    return found.select("clinical_entity", "doc_id", F.size("starts").cast("long").alias("times"))


@query
def vector_topk(spark, folder):
    near = match.vector_topk(table(spark, folder, "embeddings"), 0, 10)
    return near.withColumn("similarity", F.round("similarity", 6))
