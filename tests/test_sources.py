import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from alertloom import schemas
from alertloom.fixed.codes import EVENT_FIELDS
from alertloom.operators import flatten, quality
from alertloom.plans import load
from alertloom.sources import readers, sinks

NOW = dt.datetime(2025, 9, 14, 8, 30)
NOTICES = (
    "Date,Title,,,\r\n"
    '10/02/2024,"First, with comma",,,\r\n'
    "5/19/21,Short year,,,\r\n"
    "\xa0,Filler,,,\r\n"
    "10/02/2024,First again,,,\r\n"
)
SAFETY = " Date ,Safety Alert,Product Type\n1/2/2025,Stop use,Device\n"
EVENTS = ",".join(schemas.EVENT_FLAT.names) + "\n"


def event(number, country=""):
    cells = [f"e{number}", "20240101", "2", "Other", "No", country, "Physician", "", "Male"]
    return ",".join(cells + ["p", "b", "m", "Suspect", "Unknown", "i", "d", "X; Y", "Fatal; Unknown"])


@pytest.fixture
def folder(tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    (data / "DrugAlerts_FDA.csv").write_text(NOTICES, encoding="utf-8", newline="")
    (data / "fda_safety.csv").write_text(SAFETY)
    for part in (1, 2):
        rows = "\n".join(event(part * 1000 + i) for i in range(600))
        (data / f"drug-event-{part}.csv").write_text(EVENTS + rows + "\n")
    for stamp, name in (("2025-01-02_010101", "older"), ("2025-03-01_000000", "newest")):
        record = [name if f == "drug_name" else "" for f in schemas.RECORD.names]
        record[schemas.RECORD.names.index("update_date")] = "2025-02-30" if name == "older" else "2025-02-03"
        path = data / f"clinical_ground_truth_{stamp}.csv"
        path.write_text(",".join(schemas.RECORD.names) + "\n" + ",".join(record) + "\n")
    documents = data / "clinical_document_corpus" / "sub folder"
    documents.mkdir(parents=True)
    (documents / "a sop+%41.txt").write_text("12345")
    (documents / ".hidden.txt").write_text("x")
    (documents / "x.tmp").write_text("x")
    return data


def test_full_load(spark, folder, tmp_path):
    target = str(tmp_path / "tables")
    written = load.run(spark, str(folder), target, "gs://bucket", NOW)
    assert written == {
        "ground_truth_master": 1,
        "fda_adverse_events": 1200,
        "fda_recalls": None,
        "fda_safety_communications": 1,
        "fda_drug_alerts": 4,
        "fda_public_statements": None,
        "knowledge_base_master": 1,
    }
    counts = load.readiness(spark, target)
    assert {r.table_name: r.row_count for r in counts.collect()}["fda_recalls"] == 0
    ready = quality.readiness_summary(counts).first()
    assert (ready.ready_tables, ready.required_tables, ready.all_ready) == (4, 6, False)
    truth = spark.read.parquet(f"{target}/ground_truth_master").first()
    assert truth.drug_name == "newest" and truth.update_date == dt.date(2025, 2, 3)
    assert truth.device_name is None and len(truth.id) == 32
    notices = spark.read.parquet(f"{target}/fda_drug_alerts")
    assert notices.columns == ["Date", "Title", "processed_at", "source_file", "alert_date"]
    dates = {r.Title: r.alert_date for r in notices.collect()}
    assert dates["First, with comma"] == dt.date(2024, 10, 2)
    assert dates["Short year"] is None and dates["Filler"] is None
    safety = spark.read.parquet(f"{target}/fda_safety_communications").first()
    assert (safety["Safety Alert"], safety.alert_date) == ("Stop use", dt.date(2025, 1, 2))
    events = spark.read.parquet(f"{target}/fda_adverse_events")
    assert events.filter("occurcountry IS NULL").count() == 1200
    manifest = spark.read.parquet(f"{target}/knowledge_base_master").first()
    assert manifest.document_uri.endswith("hospital_documents/sub folder/a sop+%41.txt")
    assert (manifest.document_type, manifest.file_size_bytes) == ("CLINICAL_PROTOCOL", 5)

    # A second run replaces tables and adds no manifest row twice.
    load.run(spark, str(folder), target, "gs://bucket", NOW, event_rows=1000)
    assert spark.read.parquet(f"{target}/fda_adverse_events").count() == 1000
    assert spark.read.parquet(f"{target}/knowledge_base_master").count() == 1


def test_nested_reports_from_json_to_csv_and_back(spark, tmp_path):
    reports = [
        {"safetyreportid": "1", "serious": "1", "patient": {"reaction": [{"reactionmeddrapt": 'say "x", y'}]}},
        {"safetyreportid": "2", "serious": "2", "extra": {"deep": [1]}, "patient": {"patientonsetage": "7"}},
    ]
    source = tmp_path / "landed"
    source.mkdir()
    (source / "events.json").write_text(json.dumps({"meta": {}, "results": reports}, indent=1))
    landed = readers.read_landed(spark, str(source), schemas.EVENT_REPORT)
    assert sorted(r.source_pos for r in landed.collect()) == [0, 1]
    assert landed.first().source_file.endswith("/events.json")
    target = str(tmp_path / "drug-event-out.csv")
    sinks.write_events(flatten.flatten_adverse_events(landed), target)
    back = {r.safetyreportid: r for r in readers.read_event_csv(spark, str(tmp_path)).collect()}
    assert back["1"].reactions == 'say "x", y' and back["1"].serious == 1
    assert back["2"].reactions is None and back["2"].patientonsetage == 7.0


def test_line_breaks_in_event_values_are_kept(spark, tmp_path):
    values = ["one\ntwo", 'a "b"\r\n\r\nc, d', "plain", "x\ry", "end\n"]
    rows = [(str(i), v) for i, v in enumerate(values)]
    events = spark.createDataFrame(rows, "safetyreportid string, reactions string")
    others = [F.lit(None).cast("string").alias(c) for c in EVENT_FIELDS if c not in events.columns]
    sinks.write_events(events.select("*", *others), str(tmp_path / "drug-event-1.csv"))
    (tmp_path / "drug-event-2.csv").write_bytes(b'safetyreportid,reactions,occurcountry\n9,"far\nfrom here",US\n')
    wanted = {**dict(rows), "9": "far\nfrom here"}
    back = readers.read_event_csv(spark, str(tmp_path)).collect()
    assert len(back) == len(wanted) and {r.safetyreportid: r.reactions for r in back} == wanted
    written = load.run(spark, str(tmp_path), str(tmp_path / "tables"), "gs://bucket", NOW)
    assert written["fda_adverse_events"] == 6
    loaded = spark.read.parquet(str(tmp_path / "tables/fda_adverse_events")).collect()
    assert {r.safetyreportid: (r.reactions, r.occurcountry) for r in loaded}["9"] == ("far\nfrom here", "US")


def test_files_that_one_task_reads_are_bounded(spark, tmp_path, monkeypatch):
    """A value may hold line breaks, so a file is not split: the writer keeps each of them short."""
    monkeypatch.setattr(sinks, "RECORDS_PER_FILE", 10)
    names = schemas.EVENT_FLAT.names
    rows = [tuple(f'{n} {i}\r\n"x"' for n in names) for i in range(35)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)).coalesce(1)
    sinks.write_events(df, str(tmp_path / "drug-event-1.csv"))
    assert len(list((tmp_path / "drug-event-1.csv").glob("*.csv"))) == 4
    read = readers.read_event_csv(spark, str(tmp_path))
    assert sorted(map(str, read.select(names[0]).collect())) == sorted(map(str, df.select(names[0]).collect()))


def test_landed_lines_are_packed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "RECORDS_PER_FILE", 10)
    df = spark.range(35).selectExpr("cast(id AS string) AS safetyreportid", "repeat('x\n', 500) AS companynumb").coalesce(1)
    sinks.write_lines(df, str(tmp_path / "lines"))
    files = list((tmp_path / "lines").glob("part-*"))
    assert len(files) == 4 and sum(f.stat().st_size for f in files) < 35 * 200
    read = readers.read_landed_lines(spark, str(tmp_path / "lines"), schemas.EVENT_REPORT)
    assert sorted(tuple(r) for r in read.select(*df.columns).collect()) == sorted(tuple(r) for r in df.collect())
    order = [r.safetyreportid for r in read.orderBy("source_file", "source_pos").collect()]
    assert order == [str(i) for i in range(35)]


def test_json_lines(spark, tmp_path):
    (tmp_path / "trials.json").write_text(
        '{"protocolSection": {"identificationModule": {"nctId": "N1"}}}\n{}\n'
    )
    rows = readers.read_landed_lines(spark, str(tmp_path), schemas.CLINICAL_TRIAL)
    assert rows.count() == 2
    assert rows.filter("protocolSection.identificationModule.nctId = 'N1'").count() == 1
    assert rows.filter("source_file LIKE '%/trials.json'").count() == 2


def test_positions_of_json_lines_rise_with_the_lines(spark, tmp_path):
    for name, first in (("a", 0), ("b", 5000)):
        lines = "".join(f'{{"setid": "{first + i:06}"}}\n' for i in range(5000))
        (tmp_path / f"{name}.json").write_text(lines)
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        landed = readers.read_landed_lines(
            spark, str(tmp_path), schemas.record(setid=schemas.TEXT)
        )
        assert landed.rdd.getNumPartitions() > 4
        rows = landed.orderBy("source_file", "source_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    assert [r.setid for r in rows] == [f"{i:06}" for i in range(10000)]


def test_lists_that_landed_as_text(spark, tmp_path):
    sections = [
        '{"conditionsModule": {"conditions": "Asthma"}, "designModule": {"phases": ["P1", "P2"]}}',
        '{"conditionsModule": {"conditions": ["A, b", "C"]}}',
        "{}",
    ]
    lines = [f'{{"protocolSection": {s}}}' for s in sections] + ["{}"]
    (tmp_path / "t.json").write_text("\n".join(lines))
    landed = readers.read_landed_lines(spark, str(tmp_path), schemas.LANDED_TRIAL)
    trials = readers.trial_lists(landed).orderBy("source_pos")
    assert trials.schema["protocolSection"].dataType == (
        schemas.CLINICAL_TRIAL["protocolSection"].dataType
    )
    section = "protocolSection"
    rows = trials.select(
        f"{section}.conditionsModule.conditions", f"{section}.designModule.phases"
    ).collect()
    assert [tuple(r) for r in rows] == [
        (["Asthma"], ["P1", "P2"]),
        (["A, b", "C"], None),
        (None, None),
        (None, None),
    ]


def test_the_drug_of_a_label_listing_is_its_search_term(spark, tmp_path):
    for term in ("warfarin", "calcium salt+"):
        folder = tmp_path / f"drug={term}"
        folder.mkdir()
        (folder / "page1.json").write_text('{"data": [{"setid": "s1"}, {"setid": "s2"}]}')
    labels = readers.read_label_listings(spark, f"{tmp_path}/*/*.json")
    assert sorted((r.drug_name, r.source_pos, r.setid) for r in labels.collect()) == [
        ("calcium salt+", 0, "s1"),
        ("calcium salt+", 1, "s2"),
        ("warfarin", 0, "s1"),
        ("warfarin", 1, "s2"),
    ]


def test_columns_are_read_by_name(spark, tmp_path):
    kind = schemas.record(a=schemas.TEXT, n=schemas.WHOLE, c=schemas.TEXT)
    (tmp_path / "x1.csv").write_text("\ufeffc, n ,a\nC,1,A\n", encoding="utf-8")
    (tmp_path / "x2.csv").write_text("n,other,n\n2,zz,9\n")
    (tmp_path / "x3.csv").write_text("")
    path = f"{tmp_path}/x*.csv"
    rows = readers.read_csv(spark, path, kind).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [("A", 1, "C"), (None, 2, None)]
    (tmp_path / "x4.csv").write_text("p,q\n1,2\n")
    with pytest.raises(readers.UnknownLayout, match="x4.csv"):
        readers.read_csv(spark, path, kind)
    assert readers.read_csv(spark, path, kind, skip_unknown=True).count() == 2
    assert [f[-6:] for f in readers.csv_layouts(spark, path, kind)[1]] == ["x4.csv"]
    assert readers.read_csv(spark, f"{tmp_path}/none*.csv", kind).count() == 0


def test_key_state(spark, tmp_path):
    state = str(tmp_path / "seen")
    assert readers.read_seen(spark, state).count() == 0
    keys = spark.createDataFrame([("a",), ("b",)], "source_url STRING")
    sinks.append_seen(keys, state)
    sinks.append_seen(keys, state)
    assert sorted(r.source_url for r in readers.read_seen(spark, state).collect()) == ["a", "b"]


def test_files_with_different_columns_are_stacked_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,c\n3,4\n")
    kinds = [schemas.record(**schemas.texts("a b")), schemas.record(**schemas.texts("b c"))]
    paths = [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]
    rows = readers.read_csv_by_name(spark, paths, kinds).orderBy("b").collect()
    assert [tuple(r) for r in rows] == [("1", "2", None), (None, "3", "4")]


def test_append_new_adds_only_unknown_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        sinks.append_new(spark.createDataFrame(rows, "k INT, v STRING"), path, "k")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["a", "b", "d"]


def test_whole_texts(spark, tmp_path):
    (tmp_path / "n1.txt").write_text("line one\nline two\n")
    row = readers.read_texts(spark, str(tmp_path)).first()
    assert (row.file_name, row.text) == ("n1.txt", "line one\nline two\n")
