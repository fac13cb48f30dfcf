"""Tables written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_LOCAL: dict[str, str] = {}  # by application, for single-process masters


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only a single-process master (tests) may do without that setting and gets a temporary folder; on a
    cluster its absence is an error, since a local folder would not be seen by other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="llm-stage-")
    return _LOCAL[application]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage, survives lost executors, fixes row ids."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column of the input is called so."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, over the same memory.

    Spark bounds the bytes of a batch that it hands over; this bounds what a function makes of it, without
    a change to the session's settings.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
