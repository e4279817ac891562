"""A trie of conversation prefixes by collapsing whole sequences.

Turns are hashed once, and only hashes and word counts move. A prefix of d turns is known by two 64-bit keys: the xor of the keys of
its turns, each of which also holds its place, so that a running xor gives the keys of all prefixes and no task needs a whole conversation.
Conversations with equal last keys collapse into weighted sequences with lists of their ends. Sequences that are proper prefixes of
others leave by an anti-join, which leaves the leaves. Each sequence then adds its weight to all its prefixes, which are summed by key.

Saved tokens need no walk through the tree. Over a subtree, the sum of members times words is the sum over the sequences through its
top of weight times the words from there on. The sum of words alone counts each node with the sequence that owns it, the one of
the smallest conversation; what a sequence owns is always its end from some depth on.

Defined cases: null role or text is empty; a null turn comes first; turns of equal number follow their SHA-256; each of several equal
rows is a turn; rows without conv_id belong to no conversation and are left out; an empty table has no node; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.operators.ranges import running

from . import common

#: Ids of a list of ends that are joined to one piece of text; the pieces of a list are hashed as a stream.
CHUNK_IDS = 8192
KEY = ("depth", "k1", "k2")
NODE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, digest, words) of every turn: pos counts from 1 in the order of turn, NULL first."""
    empty = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *[v.alias(c) for c, v in empty.items()])
    return rows.withColumn("digest", _digest()).withColumn("words", F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"))


def number(hashed: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the places of hashed turns in their conversations."""
    ordered = hashed.select("conv_id", "digest", "words", F.struct("turn", "digest").alias("order"))
    return running(ordered, {"pos": ("count", F.lit(1))}, "order", ["conv_id"]).select("conv_id", "pos", "digest", "words")


def rebuild(numbered: DataFrame, group: int = 20, choices: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id) and their turns after each has taken the first h turns of the first of its group in place of its own.

    h is crc32 of the decimal conv_id, modulo choices; what the other conversation lacks is not replaced.
    """
    donor, h = F.col("conv_id") - F.col("conv_id") % group, common.crc_mod("conv_id", choices)
    convs = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"donor": donor, "h": h})
    lengths = convs.select(F.col("conv_id").alias("donor"), F.col("n").alias("donor_n"))
    convs = convs.join(lengths, "donor", "left").select("conv_id", "donor", "h", F.least("h", F.coalesce("donor_n", F.lit(0))).alias("taken"))
    others = convs.where("donor <> conv_id")
    first = numbered.where(F.col("pos") < choices).select(F.col("conv_id").alias("donor"), "pos", "digest", "words")
    head = others.join(first, "donor").where("pos <= h").select("conv_id", "pos", "digest", "words")
    own = numbered.join(convs, "conv_id").where("donor = conv_id or pos > h")
    tail = own.select("conv_id", F.when(F.col("donor") == F.col("conv_id"), F.col("pos")).otherwise(F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")
    return convs.select("conv_id"), head.unionByName(tail)


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, words, upto): the keys of each prefix and of the one before it, its last turn's words and all its words."""
    keys = {f"t{i}": F.xxhash64(F.lit(i), "pos", "digest") for i in (1, 2)}
    columns = {"k1": ("xor", F.col("t1")), "k2": ("xor", F.col("t2")), "upto": ("sum", F.col("words"))}
    out = running(rebuilt.withColumns(keys).drop("digest"), columns, "pos", ["conv_id"])
    return out.select("conv_id", F.col("pos").alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"), "words", "upto")


def _ends_sha256(lasts: DataFrame, n: int) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the ids that end at each key: sorted, comma-joined and hashed.

    The ids are sorted over all tasks and joined in pieces; a hash is a chain, so the pieces of one key are streamed through one task.
    """
    schema = "depth long, k1 long, k2 long, at long, ids string"

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            out = []
            for *k, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k != key or len(held) == CHUNK_IDS:
                    if held:
                        out.append((*key, held[0], ",".join(map(str, held))))
                    key, held = k, []
                held.append(conv)
            yield _batch(out, schema)
        if held:
            yield _batch([(*key, held[0], ",".join(map(str, held)))], schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for *k, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            yield _batch(out, "depth long, k1 long, k2 long, ends_sha256 string")
        if key is not None:
            yield _batch([(*key, state.hexdigest())], "depth long, k1 long, k2 long, ends_sha256 string")

    ordered = lasts.select(*KEY, "conv_id").repartitionByRange(n, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = ordered.mapInArrow(joined, schema).repartition(n, *KEY).sortWithinPartitions(*KEY, "at")
    return pieces.mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[x.split() for x in schema.split(", ")], strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "long" else pa.string()) for c, k in zip(columns, kinds, strict=True)], list(names))


def trie(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """The nodes of all prefixes of conversations (conv_id) with turns (conv_id, pos, digest, words): see NODE_COLUMNS.

    A node is named by its smallest member and its depth; n_leaves and saved_tokens are sums over its subtree, itself included.
    """
    spark = common.prepare(convs.sparkSession)
    n = common.width(spark, rebuilt)
    paths = common.stored(_prefixes(rebuilt), "prefixes")
    ended = paths.groupBy("conv_id").agg(F.max(F.struct(*KEY, "upto")).alias("end"))
    zero = F.lit(0).cast("long")
    lasts = common.stored(convs.join(ended, "conv_id", "left").select("conv_id", *[F.coalesce(f"end.{c}", zero).alias(c) for c in KEY], F.coalesce("end.upto", zero).alias("total")), "lasts")
    # whole sequences, each with its weight
    sequences = lasts.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("total").alias("total"))
    ends = _ends_sha256(lasts, n)
    sequences = common.stored(sequences.join(ends, list(KEY), "left"), "sequences")
    # the prefixes of one conversation of each, the root's among them
    whole = sequences.select("conv_id", F.col("depth").alias("n_turns"), "weight", "total")
    own = paths.join(whole, "conv_id").select("conv_id", *KEY, "p1", "p2", "words", "n_turns", "weight", (F.col("total") - F.col("upto") + F.col("words")).alias("rest"))
    root = whole.select("conv_id", *[zero.alias(c) for c in (*KEY, "p1", "p2", "words")], "n_turns", "weight", F.col("total").alias("rest"))
    through = common.stored(own.unionByName(root), "through")
    inner = through.where("depth < n_turns").select(*KEY).distinct()
    leaves = sequences.join(inner, list(KEY), "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    nodes = common.stored(through.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.col("weight") * F.col("rest")).alias("spent"), F.min_by("rest", "conv_id").alias("owner_rest"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    ), "nodes")
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.max("owner_rest").alias("first_rest"))  # what is left to read shrinks with depth
    marked = through.join(whole.select("conv_id").join(owned, "conv_id", "left").join(leaves, "conv_id", "left"), "conv_id")
    once = F.when(F.col("depth") >= F.col("first"), F.col("rest")).otherwise(F.coalesce("first_rest", zero))
    sums = marked.groupBy(*KEY).agg(F.sum(once).alias("once"), F.count("leaf").alias("n_leaves"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.join(sums, list(KEY)).join(children, list(KEY), "left").join(sequences.select(*KEY, "ends_sha256"), list(KEY), "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = full.join(parents, ["depth", "p1", "p2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", (F.col("spent") - F.col("once")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def last_turns(nodes: DataFrame, rebuilt: DataFrame, hashed: DataFrame) -> DataFrame:
    """nodes with the role and the text of their last turn (the root has none): texts are fetched by their hash, for the nodes alone."""
    texts = hashed.groupBy("digest").agg(F.min(F.struct("role", "text")).alias("t"))
    last = nodes.join(rebuilt.select("conv_id", F.col("pos").alias("depth"), "digest"), ["conv_id", "depth"], "left").join(texts, "digest", "left")
    return last.select(*nodes.columns, F.col("t.role").alias("role"), F.col("t.text").alias("text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations; the cases that the module names hold."""
    hashed = turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("role", "text")
    slim = common.stored(hashed, "turns")
    numbered = common.stored(number(slim), "numbered")
    common.drop(slim)
    convs, rebuilt = rebuild(numbered)
    again = common.stored(rebuilt, "rebuilt")
    return trie(convs, again).select(*NODE_COLUMNS)


OP11_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS donor, count(*) AS n,
    xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, z: xor(u >> 1, 3988292384::BIGINT * (u & 1))))) % 4 AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.donor AND t.pos <= c.h WHERE c.donor <> c.conv_id
  UNION ALL
  SELECT c.conv_id, CASE WHEN c.donor = c.conv_id THEN t.pos ELSE t.pos - c.h + least(c.h, coalesce(d.n, 0)) END, t.role, t.text
  FROM c JOIN t USING (conv_id) LEFT JOIN c AS d ON d.conv_id = c.donor WHERE c.donor = c.conv_id OR t.pos > c.h),
s AS (SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS seq FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, len(seq) AS total, depth, seq[1:depth] AS prefix FROM s, unnest(range(len(seq) + 1)) AS u(depth)),
n AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(total = depth) AS leaf,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(prefix[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS own,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
  FROM p GROUP BY prefix, depth),
below AS (SELECT a.prefix, sum(b.own)::BIGINT AS saved_tokens, count(*) FILTER (b.leaf) AS n_leaves FROM n AS a JOIN n AS b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix GROUP BY a.prefix),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children, below.n_leaves, below.saved_tokens, n.ends_sha256
FROM n JOIN below USING (prefix) LEFT JOIN kids USING (prefix) LEFT JOIN n AS up ON n.depth > 0 AND up.depth = n.depth - 1 AND up.prefix = n.prefix[1:n.depth - 1]
"""
