"""What the corpus operators share: shipping code, bounded Arrow batches, shared scratch tables."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch, whichever comes first. Texts can be long, so a batch of the default 10,000 rows could fill a worker.
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20
#: Input of one shuffle partition, about, where the session's number of partitions would leave more.
PART_BYTES = 1 << 30

_SHIPPED: set[str] = set()
#: Where the stored tables lie, for as long as somebody holds them.
_STORED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def prepare(spark: SparkSession) -> SparkSession:
    """Send this package to the executors (once a session) and bound the Arrow batches.

    A worker that has the package on its path imports the same code; on a cluster
    without it, the archive sent here is what makes the operators importable.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(Path(root.name) / p.relative_to(root)))
        where = os.path.join(tempfile.mkdtemp(), f"{root.name}-code.zip")
        Path(where).write_bytes(data.getvalue())
        spark.sparkContext.addPyFile(where)
        _SHIPPED.add(app)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int("0" + "".join(c for c in spark.conf.get(key) if c.isdigit()))  # plans are made when a result is used, so the setting has to stay
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, a new one, in local mode alone."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/llm-{tag}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: lineage ends there, and any executor can read it."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _STORED[out] = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove tables that `stored` wrote and that nothing will read again."""
    for df in tables:
        path = _STORED.pop(df, None)
        if path:
            where = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def width(spark: SparkSession, df: DataFrame | None = None) -> int:
    """Partitions of a shuffle: as the session has it, or more if df's input is so large that each would exceed PART_BYTES."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if df is None:
        return n
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(x for x in sizes if x < 1 << 60)  # larger ones stand for an unknown size
    return max(n, min(-(-size // PART_BYTES), 100_000))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def smallest(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The n rows of the smallest 64-bit hashes `key` (about; all rows if there are fewer): a bounded sample that any run repeats.

    A threshold from the number of rows leaves little more than n of them before they meet in one task.
    """
    total = df.count()
    share = (n + 8 * n**0.5) / max(1, total)
    if share < 1:
        df = df.where(key < F.lit(int(share * 2**64) - 2**63))
    return df.orderBy(key).limit(n)


def smallest_distinct(df: DataFrame, hash_column: str, n: int) -> DataFrame:
    """One row for each of the n smallest distinct hashes (about): however many copies a row has, it counts once.

    The threshold comes from an estimate of the number of distinct hashes (5 % error), so few rows more than n are shuffled,
    and the copies of each are combined before that.
    """
    total = df.agg(F.approx_count_distinct(hash_column)).first()[0]
    share = (1.25 * n + 8 * n**0.5) / max(1, total)
    if share < 1:
        df = df.where(F.col(hash_column) < F.lit(int(share * 2**64) - 2**63))
    return df.dropDuplicates([hash_column]).orderBy(hash_column).limit(n)


def crc_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id's text, modulo n."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id.cast("string").cast("binary")) % n


def text_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null becomes empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
