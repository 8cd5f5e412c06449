"""Finding documents an entity occurs in, reading their fields, vector search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PHRASE_WORDS = 3
# From the start of every word: that word and up to two more.
RUN = r"(?<!\S)(?=(\S+(?: \S+){0,2}))"


def plain_words(value: Column) -> Column:
    """Lower-cased words with single spaces; other characters only separate them."""
    return F.trim(
        F.regexp_replace(F.lower(value), r"[^\p{IsAlphabetic}\p{IsDigit}]+", " ")
    )


def affected_documents(
    entities: DataFrame,
    documents: DataFrame,
    entity: str = "clinical_entity",
    document_id: str = "doc_id",
    body: str = "text",
) -> DataFrame:
    """Pairs of entity and document whose text holds the entity's words in a row.

    An equi-join on phrases of one to three words: every word of a document
    starts three of them, each kept once per document, and an entity gives its
    leading words. The pairs found, which are few, then meet the documents once
    more, where entities of more words are held against the whole text.
    """
    named = (
        entities.select(entity)
        .distinct()
        .select(entity, plain_words(F.col(entity)).alias("_whole"))
        .filter(F.col("_whole") != "")
    )
    wanted = named.select(
        entity,
        F.substring_index("_whole", " ", PHRASE_WORDS).alias("_phrase"),
        "_whole",
    )
    run = F.col("_run")
    starts = F.array(
        *[F.substring_index(run, " ", n) for n in range(1, PHRASE_WORDS)], run
    )
    runs = F.regexp_extract_all(plain_words(F.col(body)), F.lit(RUN), 1)
    offered = documents.select(
        document_id, F.explode(F.array_distinct(runs)).alias("_run")
    ).select(document_id, F.explode(starts).alias("_phrase"))
    found = offered.join(wanted, "_phrase").select(entity, document_id, "_phrase", "_whole").distinct()
    held = F.contains(
        F.concat(F.lit(" "), plain_words(F.col(body)), F.lit(" ")),
        F.concat(F.lit(" "), F.col("_whole"), F.lit(" ")),
    )
    return (
        found.join(documents.select(document_id, body), document_id)
        .filter((F.col("_phrase") == F.col("_whole")) | held)
        .select(entity, document_id)
    )


def corpus_fields(docs: DataFrame, document_id: str, body: str = "text") -> DataFrame:
    """Title, risk level, document number, section names and entities of a text."""
    text = F.col(body)

    def group(pattern: str) -> Column:
        return F.regexp_extract(text, pattern, 1)

    title = group(r"^([^\n]*)")
    subject = F.trim(F.regexp_extract(title, r":(.*)$", 1))
    risk = group(r"(?m)^(?:Risk level|Alert Level): (.*)$")
    return docs.select(
        document_id,
        title.alias("title"),
        risk.alias("risk_level"),
        group(r"(?m)^(?:Document ID|Alert ID|Summary ID): (.*)$").alias("document_number"),
        F.array_join(
            F.regexp_extract_all(text, F.lit(r"(?m)^([A-Z][A-Z ]+):$"), 1), "|"
        ).alias("sections"),
        F.array(
            F.struct(
                F.lit("subject").alias("entity_type"),
                subject.alias("entity_value"),
                F.lit(1.0).alias("confidence"),
            ),
            F.struct(
                F.lit("risk_level").alias("entity_type"),
                risk.alias("entity_value"),
                F.lit(1.0).alias("confidence"),
            ),
        ).alias("extracted_entities"),
    )


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def vector_topk(
    vectors: DataFrame,
    query_id: int,
    k: int,
    vector_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k vectors most similar to one stored vector, by cosine.

    The query vector is a scalar subquery, so the table is scanned, not joined,
    and each task keeps its own best k.
    """
    own = F.col(embedding)
    wanted = vectors.filter(F.col(vector_id) == query_id).limit(1)
    query = wanted.select(embedding).scalar()
    length = wanted.select(F.sqrt(_dot(own, own))).scalar()
    scored = (
        vectors.filter(F.col(vector_id) != query_id)
        .withColumns({"_query": query, "_length": length})
        .select(
            vector_id,
            F.try_divide(
                _dot(own, F.col("_query")), F.sqrt(_dot(own, own)) * F.col("_length")
            ).alias("similarity"),
        )
    )
    return scored.orderBy(
        F.desc_nulls_last("similarity"), F.col(vector_id).asc()
    ).limit(k)
