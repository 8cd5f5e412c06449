"""A corpus of a wanted number of aged documents from canonical records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom import schemas
from alertloom.fixed import records as fixed
from alertloom.functions import seeded
from alertloom.operators import corpus

KEY = "document_key"


def sample_records(spark: SparkSession, as_of: dt.date | str) -> DataFrame:
    """The three records used when there is no input. Absent fields are null."""
    day = dt.date.fromisoformat(str(as_of)[:10])
    rows = []
    for record, days in zip(fixed.SAMPLE_RECORDS, fixed.SAMPLE_DEADLINE_DAYS):
        values = {
            **record,
            "update_date": str(day),
            "compliance_deadline": str(day + dt.timedelta(days)),
        }
        rows.append(tuple(values.get(f) for f in schemas.RECORD_TEXT.names))
    return spark.createDataFrame(rows, schemas.RECORD_TEXT)


def build(
    records: DataFrame,
    total: int,
    as_of: dt.date | str,
    years: int = 5,
    seed: int | str = 42,
) -> DataFrame:
    """``total`` documents; the number of records is counted once."""
    available = records.count()
    if available == 0:
        records = sample_records(records.sparkSession, as_of)
        available = len(fixed.SAMPLE_RECORDS)
    fields = [c for c in records.columns if c in schemas.RECORD_TEXT.names]
    spread = corpus.spread(records, total, available, fields, seed)
    keyed = spread.withColumn(
        KEY, seeded.digest(*[F.col(c) for c in fields], F.col("copy"))
    ).withColumn("sequence", seeded.hash_int(F.col(KEY), digits=15))
    return corpus.documents(keyed, [KEY], as_of, years, seed, sequence="sequence")
