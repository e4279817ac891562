"""Which files need work again: content hashes against a saved state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .digests import hash_files  # noqa: F401

#: What is kept of each file.
STATE = "name string, digest string, size long, first_seen string, last_processed string"


def detect_changes(now: DataFrame, state: DataFrame, outputs: DataFrame | None = None, force: bool = False) -> DataFrame:
    """(name, status) with status new, changed, unchanged or gone.

    now: (name, digest, ..), state: (name, digest, ..), outputs: (name). A file whose output is missing is changed even if its
    hash is not; force makes all present files changed.
    """
    old = state.select("name", F.col("digest").alias("_old"))
    both = now.select("name", "digest").join(old, "name", "full")
    if outputs is not None:
        both = both.join(outputs.select("name", F.lit(True).alias("_out")).distinct(), "name", "left")
    else:
        both = both.withColumn("_out", F.lit(True))
    again = F.lit(force) | (F.col("digest") != F.col("_old")) | F.col("_out").isNull()
    status = F.when(F.col("digest").isNull(), "gone").when(F.col("_old").isNull(), "new").when(again, "changed").otherwise("unchanged")
    return both.select("name", status.alias("status"))


def next_state(now: DataFrame, state: DataFrame, at: str) -> DataFrame:
    """The state after a run at `at`: first_seen is kept, vanished files are forgotten."""
    old = state.select("name", F.col("first_seen").alias("_first"), F.col("digest").alias("_digest"), F.col("last_processed").alias("_last"))
    done = F.when(F.col("digest") == F.col("_digest"), F.col("_last")).otherwise(F.lit(at))
    return now.join(old, "name", "left").select("name", "digest", "size", F.coalesce("_first", F.lit(at)).alias("first_seen"), done.alias("last_processed"))


def orphans(outputs: DataFrame, inputs: DataFrame, key: str) -> DataFrame:
    """Outputs without an input of the same key."""
    return outputs.join(inputs.select(key).distinct(), key, "left_anti")


def remove_orphans(spark: SparkSession, folder: str, outputs: DataFrame, inputs: DataFrame, key: str) -> list[str]:
    """Delete the outputs (key, name) below folder whose input is gone, and give their names; a file that is gone already is no error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(r["name"] for r in orphans(outputs, inputs, key).select("name").distinct().collect())  # one row a file
    for n in names:
        if "/" in n or n in ("", ".", ".."):
            raise ValueError(f"{n!r} is no name of a file in {folder}")
        fs.delete(hadoop(folder, n), True)
    return names


def may_skip(changes: DataFrame, output_exists: bool, force: bool, from_start: bool) -> bool:
    """Nothing changed since the output was written, and the run was to begin at the first step."""
    return output_exists and from_start and not force and not changes.where("status <> 'unchanged'").take(1)
