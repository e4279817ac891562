"""New files of a folder as a stream that ends when all are read.

The file source remembers in its checkpoint what it has read, so each call takes only files that are new. Files that
changed or vanished are the business of `sources.incremental`, whose hashes notice them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtab.sources.ingest import file_name


def take_new(spark: SparkSession, folder: str, columns: list[str], sink: Callable[[DataFrame, int], None], checkpoint: str, fmt: str = "csv", files_a_batch: int = 1000) -> None:
    """Hand the rows of new files to sink(batch, number), all columns as text, with the file's name in _source_file.

    A batch that failed is handed over again under the same number: the sink must write by number.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_a_batch)
    rows = (reader.option("header", True) if fmt == "csv" else reader).load(folder)
    named = rows.withColumn("_source_file", file_name())
    named.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def write_by_number(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that may be called twice for a batch: each number has a folder of its own."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
