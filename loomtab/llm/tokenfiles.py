"""Token-id files: one array of ids of all documents of a shard, and Elias-Fano codes of where each document ends.

A shard holds consecutive documents in ascending doc_id order; shards follow each other in that order. Layout, little-endian:

    magic (8 bytes) | ids, 2 or 4 bytes each | Elias-Fano: n + 1 boundaries | Elias-Fano: doc_ids less the first | footer

The footer has the width of an id, the first doc_id, how many rows at the start have no doc_id, and the places of the parts.
A task streams its sorted documents into a file of its own name and renames it when it is whole, so a task that is run
again, or twice at once, leaves whole files only, and the manifest (one row a shard, stored before anything is read)
names the one that counts. Files go to a folder that all executors share, through pyarrow's file systems.

Defined cases: null or empty text has the end id alone; a null doc_id sorts first and is returned as null; repeated rows
are separate documents; an empty table gives no shard and no rows; other columns are not read.
"""

from __future__ import annotations

import array
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens
from .eliasfano import EliasFano

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
MAGIC = b"IDSHARD1"
FOOTER = struct.Struct("<BqQQQQ8s")  # id width, first doc_id, rows without doc_id, start of the boundaries, of the doc_ids, of the footer
#: Ids that a reader holds at once, unless one document has more; documents whose places it selects at once.
READ_IDS, READ_DOCS = 1 << 20, 4096
#: Documents and ids of a shard at most.
SHARD_DOCS, SHARD_IDS = 2_000_000, 1 << 30


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def folder_uri(spark: SparkSession, path: str) -> str:
    """The full URI of a folder under the default file system of the cluster."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    at = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return at.replace("file:/", "file:///", 1) if at.startswith("file:/") and not at.startswith("file://") else at


def _tail(bare: int, doc_ids: array.array, lengths: array.array, width: int) -> bytes:
    """What follows the ids in a shard's file; bare rows without doc_id come before those with one."""
    known = np.frombuffer(doc_ids, np.int64) if doc_ids else np.empty(0, np.int64)
    first = int(known[0]) if len(known) else 0
    ends = np.concatenate(([0], np.cumsum(np.frombuffer(lengths, np.int64))))
    a = len(MAGIC) + int(ends[-1]) * width
    one, two = EliasFano.of(ends).to_bytes(), EliasFano.of(known - first).to_bytes()
    return one + two + FOOTER.pack(width, first, bare, a, a + len(one), a + len(one) + len(two), MAGIC)


def write(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Encode docs (doc_id, text) into shards below folder; returns the stored manifest (shard, part, file, documents, ids).

    A task's documents go into one shard, or into several parts of SHARD_DOCS documents or SHARD_IDS ids at most (but one
    document has one part), so what a task holds beside the open file does not grow with its share of the table.
    """
    spark = common.prepare(docs.sparkSession)
    uri = folder_uri(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder, end = TaskContext.get().partitionId(), tokens.encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        small = max(encoder.size(), end_id + 1) <= 1 << 16
        files, base = _files(uri)
        open_, part = None, 0
        for batch in batches:
            if not part and open_ is None:
                files.create_dir(base, recursive=True)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if open_ is None:
                    open_ = _Open(files, f"{base}/shard-{shard:06d}-{part:04d}-{uuid.uuid4().hex[:8]}", small)
                b = (encoder.encode(text) if text else b"") + end
                open_.add(doc_id, b)
                if len(open_.lengths) >= SHARD_DOCS or open_.total >= SHARD_IDS:
                    yield open_.close(shard, part)
                    open_, part = None, part + 1
        if open_ is not None:
            yield open_.close(shard, part)

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(common.width(spark, docs), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = common.stored(ordered.mapInArrow(run, "shard int, part int, file string, documents long, ids long"), "manifest")
    _sweep(uri, manifest)
    return manifest.withColumn("folder", F.lit(uri))


class _Open:
    """A shard that is being written."""

    def __init__(self, files, name: str, small: bool):
        self.files, self.name, self.small = files, name, small
        self.out = files.open_output_stream(f"{name}.part")
        self.out.write(MAGIC)
        self.bare, self.total = 0, 0
        self.doc_ids, self.lengths = array.array("q"), array.array("q")

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if doc_id is None:
            self.bare += 1
        else:
            self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.total += len(ids) // 4
        self.out.write(np.frombuffer(ids, "<u4").astype("<u2").tobytes() if self.small else ids)

    def close(self, shard: int, part: int) -> pa.RecordBatch:
        self.out.write(_tail(self.bare, self.doc_ids, self.lengths, 2 if self.small else 4))
        self.out.close()
        self.files.move(f"{self.name}.part", self.name)
        row = ((shard, pa.int32()), (part, pa.int32()), (self.name, pa.string()), (len(self.lengths), pa.int64()), (self.total, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in row], ["shard", "part", "file", "documents", "ids"])


def _sweep(uri: str, manifest: DataFrame) -> None:
    """Remove what killed or repeated tasks left in the folder: files that the manifest does not name. Its rows are one a shard."""
    from pyarrow import fs

    files, base = _files(uri)
    named = {r["file"] for r in manifest.select("file").collect()}
    if named:
        for x in files.get_file_info(fs.FileSelector(base)):
            if x.type == fs.FileType.File and x.path not in named and x.base_name.startswith("shard-"):
                files.delete_file(x.path)


class Shard:
    """A file, open for reading: offsets by select, ids by position."""

    def __init__(self, uri: str, name: str):
        files, _ = _files(uri)
        self.file = files.open_input_file(name)
        size = self.file.size()
        self.width, self.first, self.bare, a, b, c, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name} is not a shard of token ids")
        self.ends = EliasFano.from_bytes(self.file.read_at(b - a, a))
        self.doc_ids = EliasFano.from_bytes(self.file.read_at(c - b, b))
        self.documents = self.ends.n - 1

    def doc_id(self, i: int) -> int | None:
        return None if i < self.bare else self.first + self.doc_ids.select(i - self.bare)

    def span(self, i: int) -> tuple[int, int]:
        return self.ends.select(i), self.ends.select(i + 1)

    def bounds(self, i: int, j: int) -> np.ndarray:
        """Where the documents from the i-th to before the j-th start, and where the last of them ends: by select, for these alone."""
        return self.ends.block(i, j + 1)

    def names(self, i: int, j: int) -> list[int | None]:
        """The doc_ids of these documents."""
        a, b = max(i, self.bare), max(j, self.bare)
        return [None] * (min(j, self.bare) - min(i, self.bare)) + (self.first + self.doc_ids.block(a - self.bare, b - self.bare)).tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - start) * self.width, len(MAGIC) + start * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards of a manifest; start counts ids over all shards."""
    spark = common.prepare(manifest.sparkSession)
    rows = manifest.orderBy("shard", "part").collect()  # one small row a shard
    base, todo = 0, []
    for r in rows:
        todo.append((r["folder"], r["file"], base))
        base += r["ids"]
    shards = spark.createDataFrame(todo, "folder string, file string, base long").repartition(max(1, len(todo)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["folder"], row["file"])
                i = 0
                while i < shard.documents:
                    ends = shard.bounds(i, min(i + READ_DOCS, shard.documents))
                    n = max(1, int(np.searchsorted(ends, ends[0] + READ_IDS, "right")) - 1)
                    ends = ends[: n + 1]
                    block, at = shard.ids(int(ends[0]), int(ends[n])), ends - ends[0]
                    crc = [zlib.crc32(block[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.names(i, i + n), pa.int64()), pa.array(ends[:-1] + row["base"]), pa.array(np.diff(at)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    i += n

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the files, read back from them, in the cases that the module names."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return read(write(docs, common.new_path(spark, "ids")))
