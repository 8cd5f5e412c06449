"""A positional inverted index of documents, kept in files, and phrases found from it.

    postings   token, document, positions; in folders by hash of the token
    documents  which generation of postings a document's text is in

Documents are added as a generation of their own, so an addition writes what it adds and no
more; a document that comes again, or is removed, leaves postings that no longer count, which a
merge drops. Parts change in one version (`snapshots`), so a reader sees whole additions only.

A phrase is looked up by its rarest token, of which the folder is read alone; the documents found
there meet the postings of its other tokens, and positions are intersected. What is shuffled goes
with the occurrences of rarest tokens, not with the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.operators.match import plain_words
from alertloom.session import settle
from alertloom.sources import snapshots
from alertloom.sources.snapshots import Snapshot

POSTINGS, DOCUMENTS = "postings", "documents"
BUCKETS = 64
BUCKET = "bucket"
FEW = 8  # generations before they are merged


def _postings(document_id: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("token", T.StringType()),
            T.StructField("document", document_id.dataType),
            T.StructField("positions", T.ArrayType(T.IntegerType())),
            T.StructField("generation", T.LongType()),
            T.StructField(BUCKET, T.IntegerType()),
        ]
    )


def _held(document_id: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("document", document_id.dataType),
            T.StructField("generation", T.LongType()),
            T.StructField("present", T.BooleanType()),
        ]
    )


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def tokens(documents: DataFrame, document_id: str, body: str) -> DataFrame:
    """(token, document, positions): the places, from 0, of each word of a text.

    Words meet within their row. An id that comes twice has as many rows of a token.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            document, words = batch.column(0), batch.column(1).to_pylist()
            found, owner, positions = [], [], []
            for row, line in enumerate(words):
                at: dict[str, list[int]] = {}
                for place, token in enumerate(line.split(" ") if line else ()):
                    at.setdefault(token, []).append(place)
                at.pop("", None)
                found += at
                positions += at.values()
                owner += [row] * len(at)
            yield pa.record_batch(
                {
                    "token": pa.array(found, pa.string()),
                    "document": document.take(pa.array(owner, pa.int64())),
                    "positions": pa.array(positions, pa.list_(pa.int32())),
                }
            )

    kind = documents.schema[document_id].dataType.simpleString()
    words = documents.select(F.col(document_id).alias("document"), plain_words(F.col(body)).alias("words"))
    return words.mapInArrow(places, f"token string, document {kind}, positions array<int>")


def _write_postings(rows: DataFrame):
    """Each folder is written by as many tasks as come to it, so that a common word is not one task's."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("document"), F.lit(max(1, tasks // BUCKETS)))
    dealt = rows.withColumn(BUCKET, _bucket(F.col("token"))).repartition(BUCKET, part).sortWithinPartitions(BUCKET, "token")
    return lambda path: dealt.write.partitionBy(BUCKET).parquet(path)


def add(
    documents: DataFrame, root: str, document_id: str = "doc_id", body: str = "text", merge: bool = True
) -> Snapshot:
    """Put documents into the index below `root`; one that is there already is replaced.

    Ids must be unique and not null. A text without words is kept as a document that nothing is
    found in.
    """
    spark = documents.sparkSession
    base = snapshots.snapshot(spark, root)
    generation = int(base.notes.get("generation", 0)) + 1
    rows = tokens(documents, document_id, body).withColumn("generation", F.lit(generation).cast("long"))
    names = {
        POSTINGS: [snapshots.stage(base, POSTINGS, _write_postings(rows))],
        DOCUMENTS: [snapshots.stage(base, DOCUMENTS, _entries(documents, document_id, generation, True).write.parquet)],
    }
    now = snapshots.commit(spark, base, names, notes={"generation": generation})
    kind = documents.schema[document_id]
    return compact(spark, now, kind) if merge and len(now.parts[POSTINGS]) > FEW else now


def remove(documents: DataFrame, root: str, document_id: str = "doc_id") -> Snapshot:
    """Take the documents with these ids out of the index; ids that it does not hold change nothing."""
    spark = documents.sparkSession
    base = snapshots.snapshot(spark, root)
    generation = int(base.notes.get("generation", 0)) + 1
    gone = _entries(documents, document_id, generation, False)
    name = snapshots.stage(base, DOCUMENTS, gone.write.parquet)
    return snapshots.commit(spark, base, {DOCUMENTS: [name]}, notes={"generation": generation})


def _entries(documents: DataFrame, document_id: str, generation: int, present: bool) -> DataFrame:
    return documents.select(
        F.col(document_id).alias("document"),
        F.lit(generation).cast("long").alias("generation"),
        F.lit(present).alias("present"),
    )


def current(spark: SparkSession, held: Snapshot, document_id: T.StructField) -> DataFrame:
    """(document, generation) of the documents that the index holds."""
    entries = held.read(spark, DOCUMENTS, _held(document_id))
    last = F.max_by("present", "generation").alias("present")
    newest = entries.groupBy("document").agg(F.max("generation").alias("generation"), last)
    return newest.where("present").drop("present")


def compact(spark: SparkSession, held: Snapshot, document_id: T.StructField) -> Snapshot:
    """All generations as one, without the postings that no longer count."""
    valid = current(spark, held, document_id)
    rows = _read_postings(spark, held, document_id).drop(BUCKET).join(valid, ["document", "generation"], "left_semi")
    names = {
        POSTINGS: [snapshots.stage(held, POSTINGS, _write_postings(rows))],
        DOCUMENTS: [snapshots.stage(held, DOCUMENTS, valid.withColumn("present", F.lit(True)).write.parquet)],
    }
    return snapshots.commit(spark, held, {}, names)


def _read_postings(
    spark: SparkSession, held: Snapshot, document_id: T.StructField, buckets: list[int] | None = None
) -> DataFrame:
    """The postings, of some buckets alone if asked for: the others' folders are not read."""
    schema = _postings(document_id)
    out = spark.createDataFrame([], schema)
    for folder in held.folders(POSTINGS):
        rows = spark.read.schema(schema).parquet(folder)
        out = out.unionByName(rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets)))
    return out


def _buckets_of(probes: DataFrame) -> list[int]:
    """The folders of the tokens; there are at most as many as BUCKETS."""
    return sorted(r[0] for r in probes.select(_bucket(F.col("token"))).distinct().collect())


def find(
    entities: DataFrame,
    held: Snapshot,
    document_id: T.StructField,
    entity: str = "clinical_entity",
) -> DataFrame:
    """(entity, document, starts): the documents that hold the entity's words in a row, and where.

    `starts` are the places of the first word, in order. Entities without words are found nowhere.
    """
    spark = entities.sparkSession
    named = entities.select(F.col(entity).alias("entity")).distinct()
    words = F.split(plain_words(F.col("entity")), " ")
    # Settled, so that Spark knows how small it is, and leaves the postings where they lie if it can.
    probes = settle(named.select("entity", F.posexplode(words).alias("offset", "token")).where("token != ''"), "probes")
    wanted = probes.select("token").distinct()
    postings = _read_postings(spark, held, document_id, _buckets_of(wanted))
    # How many documents hold each wanted token: an overestimate where postings are outdated.
    rows = postings.join(wanted, "token", "left_semi")
    counts = rows.groupBy("token").agg(F.count("*").alias("documents"))
    weighed = probes.join(counts, "token", "left").withColumn("documents", F.coalesce("documents", F.lit(0)))
    phrases = weighed.groupBy("entity").agg(
        F.min(F.struct("documents", "offset", "token")).alias("rarest"),
        F.collect_list(F.struct("offset", "token")).alias("all"),
    )
    phrases = phrases.where("rarest.documents > 0")
    shift = lambda positions, offset: F.transform(positions, lambda p: p - offset)
    lead = phrases.select(
        "entity", "all", F.col("rarest.offset").alias("offset"), F.col("rarest.token").alias("token")
    )
    lead = settle(lead, "lead")
    valid = current(spark, held, document_id)
    found = (
        rows.join(lead, "token")
        .join(valid, ["document", "generation"], "left_semi")
        .select(
            "entity",
            "document",
            "generation",
            F.filter(shift(F.col("positions"), F.col("offset")), lambda p: p >= 0).alias("starts"),
            F.filter("all", lambda x: x["offset"] != F.col("offset")).alias("rest"),
        )
    )
    # An id that came twice in one addition has several rows of a token.
    single = (
        found.where(F.size("rest") == 0)
        .groupBy("entity", "document")
        .agg(F.sort_array(F.flatten(F.collect_list("starts"))).alias("starts"))
    )
    more = found.where(F.size("rest") > 0).select("entity", "document", "generation", "starts", F.size("rest").alias("n"), F.inline("rest"))
    # Rows for each other token of a candidate; the phrase stands where all of them agree.
    met = more.join(rows.select("token", "document", "generation", "positions"), ["token", "document", "generation"]).select(
        "entity", "document", "n", "offset", F.array_intersect("starts", shift(F.col("positions"), F.col("offset"))).alias("starts")
    )
    agreed = (
        met.where(F.size("starts") > 0)
        .select("entity", "document", "n", "offset", F.explode("starts").alias("start"))
        .groupBy("entity", "document", "n", "start")
        .agg(F.size(F.collect_set("offset")).alias("agreeing"))
        .where("agreeing = n")
        .groupBy("entity", "document")
        .agg(F.sort_array(F.collect_list("start")).alias("starts"))
    )
    both = single.unionByName(agreed)
    return both.select(F.col("entity").alias(entity), F.col("document").alias(document_id.name), "starts")
