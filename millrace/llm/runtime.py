"""Session settings, table reading and Arrow helpers shared by the operators.

The operators see two columns only, an id and a text. Whatever else a table
carries, under whatever names, never meets the columns an operator adds.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import tune

#: Rows and bytes of one Arrow batch: a worker holds one batch of texts at a time.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def ready(spark: SparkSession) -> SparkSession:
    """Bounded Arrow batches; local workers find this package as the driver does."""
    tune(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (bigint) and ``text``, nothing else."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end and the offsets of its rows; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return (data[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(offsets) else (data[:0], np.zeros(1, np.int64))


def texts(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()


def keep_rows(docs: DataFrame, verdict: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """Rows of ``docs`` for which ``verdict`` holds, all columns unchanged."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(np.asarray(verdict(batch), bool)))

    return docs.mapInArrow(kept, docs.schema)
