"""Content digests of files of any size: hashed on the executors by pieces of a fixed length, streamed, never as a row.

A file's digest is the SHA-256 of its length and of the SHA-256 of its pieces in order, so it does not depend on how Spark deals the
pieces, or on the way they are read: Python opens what it can (local and mounted paths, and stores that Arrow knows); in other stores
Spark's reader takes files up to its limit of 2 GB each.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a piece, part of the digest's definition, and of one read.
PIECE, READ = 16 << 20, 1 << 20


def python_opens(path: str) -> bool:
    """Whether executors can open the path without Spark; asked on the driver, by its scheme."""
    if urlparse(path).scheme in ("", "file"):
        return True
    try:
        from pyarrow import fs

        fs.FileSystem.from_uri(path)
        return True
    except Exception:  # whatever a store that is not there raises
        return False


def opener():
    """A function that opens a path as Spark writes it; made anew at each call, so that it travels to executors by value."""
    def stream(uri: str):
        from urllib.parse import unquote, urlparse

        parts = urlparse(uri)
        if parts.scheme in ("", "file"):
            import os

            at = uri.removeprefix("file://").removeprefix("file:")
            return open(at if os.path.exists(at) else unquote(at), "rb")
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(uri)
        return store.open_input_file(at)

    return stream


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, name, size) of a folder's files; none is opened. Spark's reader passes over files without bytes, so those come from its list of names."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    files = found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))
    every = spark.createDataFrame([(x,) for x in found.inputFiles()], "uri string")  # names, not rows
    path = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))
    empty = every.select(path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("name"), F.lit(0).cast("long").alias("size")).join(files, "name", "left_anti")
    return files.unionByName(empty)


def hash_files(spark: SparkSession, folder: str, pattern: str = "*", piece: int = PIECE) -> DataFrame:
    """(name, digest, size) of a folder's files. Pieces of all files spread over the executors; a task holds READ bytes at a time."""
    files = list_files(spark, folder, pattern)
    last = F.greatest(F.lit(0), F.floor((F.col("size") - 1) / piece)).cast("long")
    if python_opens(folder):
        pieces = files.select("path", "name", "size", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("nth"))
        spread = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("path", "nth"))
        stream, read = opener(), READ

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import hashlib

            for batch in batches:
                out = []
                for path, nth in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    leaf, left = hashlib.sha256(), piece
                    with stream(path) as f:
                        f.seek(nth * piece)
                        while left and (block := f.read(min(read, left))):
                            leaf.update(block)
                            left -= len(block)
                    out.append(leaf.hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array(out, pa.string())], ["name", "size", "nth", "leaf"])

        leaves = spread.mapInArrow(run, "name string, size long, nth long, leaf string")
        in_order = F.transform(F.array_sort(F.collect_list(F.struct("nth", "leaf"))), lambda x: x["leaf"])
        joined = leaves.groupBy("name", "size").agg(F.array_join(in_order, "").alias("leaves"))
    else:
        content = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        size, name = F.col("length"), F.element_at(F.split("path", "/"), -1)
        nths = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((size - 1) / piece)).cast("int"))
        leaves = F.transform(nths, lambda i: F.sha2(F.substring("content", i * piece + 1, F.lit(piece)), 256))
        joined = content.select(name.alias("name"), size.alias("size"), F.array_join(leaves, "").alias("leaves"))
        empty = files.where("size = 0").select("name", "size", F.sha2(F.lit("").cast("binary"), 256).alias("leaves"))
        joined = joined.unionByName(empty)
    return joined.select("name", F.sha2(F.concat_ws(":", F.col("size").cast("string"), "leaves").cast("binary"), 256).alias("digest"), "size")
