"""Tables that are replaced whole: every version is a folder of its own, and a numbered pointer file names the one that counts.

A writer fills a new folder first and then creates the next pointer, which only one writer can. A reader takes the newest pointer, so it
sees the whole old version or the whole new one at every moment; a writer that fails leaves an unnamed folder, which `vacuum` removes.
Exclusive creation of a file is what guards it: HDFS has it; on stores without it see to one writer a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .scratch import hadoop, remove

POINTERS = "_versions"


class Conflict(RuntimeError):
    """Another writer has committed the version that this one was to be."""


def _text(spark: SparkSession, fs, at) -> str:
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the committed versions, oldest first. A pointer whose writer died before naming a folder is passed over."""
    fs, at = hadoop(spark, f"{path}/{POINTERS}")
    if not fs.exists(at):
        return []
    found = [(int(x.getPath().getName()), x.getPath()) for x in fs.listStatus(at) if x.getPath().getName().isdigit()]
    return [(n, folder) for n, p in sorted(found, key=lambda x: x[0]) if (folder := _text(spark, fs, p))]


def latest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The newest version; pointers are looked at from the newest on."""
    fs, at = hadoop(spark, f"{path}/{POINTERS}")
    if not fs.exists(at):
        return None
    numbers = sorted((int(x.getPath().getName()) for x in fs.listStatus(at) if x.getPath().getName().isdigit()), reverse=True)
    for n in numbers:
        if folder := _text(spark, *hadoop(spark, f"{path}/{POINTERS}/{n:09d}")):
            return n, folder
    return None


def _last_number(spark: SparkSession, path: str) -> int:
    fs, at = hadoop(spark, f"{path}/{POINTERS}")
    if not fs.exists(at):
        return 0
    return max((int(x.getPath().getName()) for x in fs.listStatus(at) if x.getPath().getName().isdigit()), default=0)


def commit(spark: SparkSession, path: str, folder: str, after: int | None = None) -> int:
    """Make folder (a name below path) the newest version. after: the version that it was derived from; Conflict if that is not the newest."""
    now = latest(spark, path)
    if after is not None and (now[0] if now else 0) != after:
        raise Conflict(f"{path} is at version {now[0] if now else 0}, not {after}")
    number = _last_number(spark, path) + 1
    fs, at = hadoop(spark, f"{path}/{POINTERS}/{number:09d}")
    try:
        out = fs.create(at, False)
    except Exception as e:
        raise Conflict(f"version {number} of {path} was taken by another writer") from e
    out.write(bytearray(folder.encode()))
    out.close()
    return number


def new_version(path: str) -> str:
    """A folder name that no version has."""
    return f"v-{uuid.uuid4().hex[:12]}"


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), after: int | None = None) -> DataFrame:
    """Make df, which may itself read path, the newest version of the table at path, and give that version back."""
    spark, folder = df.sparkSession, new_version(path)
    try:
        df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}") if partition_by else df.write.parquet(f"{path}/{folder}")
        commit(spark, path, folder, after)
    except Exception:
        remove(spark, f"{path}/{folder}")
        raise
    return spark.read.schema(df.schema).parquet(f"{path}/{folder}")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one of that number."""
    found = latest(spark, path) if version is None else next((v for v in versions(spark, path) if v[0] == version), None)
    if found is None:
        raise FileNotFoundError(f"{path} has no version {version if version is not None else 'yet'}")
    return spark.read.parquet(f"{path}/{found[1]}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest `keep` versions, and folders that no pointer names. Run it while no writer is at work."""
    found = versions(spark, path)
    kept = {folder for _, folder in found[-max(1, keep):]}
    fs, at = hadoop(spark, path)
    gone = sorted(n for x in fs.listStatus(at) if (n := x.getPath().getName()).startswith("v-") and n not in kept)
    for n in gone:
        remove(spark, f"{path}/{n}")
    for number, folder in found:
        if folder not in kept:
            remove(spark, f"{path}/{POINTERS}/{number:09d}")
    return gone
