"""Repeated strings in runs of few characters: against formulas, and against brute force where texts are short."""

import hashlib
import inspect
import random

import numpy as np
import pyarrow as pa
import pytest

from loomtab.llm import repeats, tokenfiles
from loomtab.llm.eliasfano import EliasFano
from tests.llm.test_operators import kept


def removed(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove(df).collect()}


def test_thirty_megabytes_of_few_characters(spark):
    """Of a run of period p the first p windows are news, so its first p bytes stay."""
    n = 30_000_000
    got = removed(spark, {1: "-" * n, 2: "=+" * (n // 2), 3: "-" * (n // 3)})
    want = lambda size, rest: (size, size - len(rest), 1, hashlib.sha256(rest).hexdigest())
    assert got == {1: want(n, b"-"), 2: want(n, b"=+"), 3: want(n // 3, b"")}


def test_many_documents_with_long_rulers(spark):
    """300 documents with rulers of 20 to 120 kB of three kinds between words of their own."""
    rng, texts = random.Random(3), {}
    ruler = {0: "=", 1: "-=", 2: "abcdefghij klm "}
    sizes = {}
    for i in range(300):
        sizes[i] = rng.randrange(20_000, 120_000) // 30 * 30
        head, tail = (" ".join(str(rng.random()) for _ in range(20)) for _ in range(2))
        texts[i] = f"{head}|{ruler[i % 3] * (sizes[i] // len(ruler[i % 3]))}|{tail}"
    got = removed(spark, texts)
    for i in range(60, 300):  # by now an earlier ruler is as long, so the whole of it goes, with a few bytes beside it that agree by chance
        assert got[i][0] == len(texts[i]) and sizes[i] <= got[i][1] <= sizes[i] + 16 and got[i][2] == 1, i


@pytest.mark.parametrize("seed", range(4))
def test_runs_by_brute_force(spark, monkeypatch, seed):
    """Short runs of many periods, in deals of few anchors, segments and batches of few bytes."""
    for name, value in (("HOT", 3), ("SEGMENT", 257), ("BATCH_BYTES", 900), ("SORT_BYTES", 2000)):
        monkeypatch.setattr(repeats, name, value)
    rng, texts = random.Random(seed), {}
    for i in range(30):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            unit = "".join(rng.choice("ab=- ") for _ in range(rng.choice([1, 2, 3, 7, 19, 20, 21, 45, 81, 90])))
            parts.append((unit * 400)[: rng.randrange(40, 400)] + rng.choice(["", "|", str(rng.random())]))
        texts[i] = "".join(parts)
    assert removed(spark, texts) == kept({k: t.encode() for k, t in texts.items()})


def test_stretches_of_runs_stay_small():
    """A run takes a few bytes a byte, in batches of bounded size, and its anchors spread over the deals of their hash."""
    data = b"-" * 1_000_000
    h, first, last, several = repeats._anchors(np.frombuffer(data, np.uint8))
    assert int((last - first + repeats.WINDOW).sum()) < 4 * len(data) and first[0] == 0 and last[-1] == len(data) - repeats.WINDOW and (first[1:] == last[:-1] + 1).all() and several[:-1].all()
    lists = pa.array([[{"number": i, "deals": 9} for i in range(len(h))]], pa.list_(pa.struct([("number", pa.int32()), ("deals", pa.int32())])))
    out = list(repeats._stretches(iter([pa.RecordBatch.from_arrays([pa.array([5]), pa.array([data], pa.binary()), lists], ["rank", "bytes", "anchors"])])))
    deals = np.bincount(np.concatenate([b.column(1).to_numpy() for b in out]))
    assert len(deals) == 9 and deals.max() < 2 * deals.mean() and all(b.column(4).nbytes < 2 * repeats.BATCH_BYTES for b in out)
    rows = list(repeats._chunks(iter(b.slice(i, 100) for b in out for i in range(0, b.num_rows, 100)), ("hash", "deal")))
    assert sum(t.num_rows for t in rows) == len(h)


def test_spans_of_a_text_are_merged():
    rank, spans = repeats._listed(np.array([2, 1, 1, 1, 2, 1]), np.array([0, 10, 0, 4, 50, 30]), np.array([9, 20, 5, 10, 60, 31]))
    assert rank.to_pylist() == [1, 2] and [[(s["a"], s["b"]) for s in x] for x in spans.to_pylist()] == [[(0, 20), (30, 31)], [(0, 9), (50, 60)]]


# token-id files: places by select


@pytest.mark.parametrize("n,step", [(1, 1), (7, 0), (256, 3), (257, 1000), (5000, 1), (5000, 77), (3000, 10**9)])
def test_select_of_stretches(n, step):
    """Every stretch of values that `block` selects equals the values encoded."""
    rng = random.Random(n * 31 + step % 97)
    values = np.cumsum([rng.randrange(step + 1) for _ in range(n)])
    code = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    for _ in range(60):
        i = rng.randrange(n + 1)
        j = rng.choice([i, n, min(n, i + 1), rng.randrange(i, n + 1)])
        assert code.block(i, j).tolist() == values[i:j].tolist()
    with pytest.raises(IndexError):
        code.block(0, n + 1)


def test_files_are_read_by_select_alone(spark, monkeypatch, tmp_path):
    """The query's reader works where neither code can be spread out whole; blocks of documents and ids are cut anywhere."""
    df = spark.createDataFrame([(i if i % 9 else None, "word " * (i % 4)) for i in range(300)], "doc_id long, text string").coalesce(1)
    manifest = tokenfiles.write(df, str(tmp_path / "ids"))
    want = sorted(tuple(r) for r in tokenfiles.read(manifest).select("start", "n_tokens", "ids_crc32").collect())
    rows = manifest.orderBy("shard").collect()

    def never(self):
        raise AssertionError("a whole code was spread out")

    monkeypatch.setattr(EliasFano, "decode", never)
    at = 0
    for r in rows:
        shard = tokenfiles.Shard(r["folder"], r["file"])
        for i in range(0, shard.documents, 7):
            j = min(i + 7, shard.documents)
            ends, names = shard.bounds(i, j), shard.names(i, j)
            assert names == [shard.doc_id(k) for k in range(i, j)] and list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)) == [shard.span(k) for k in range(i, j)]
            assert [(at + a, b - a) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)] == [w[:2] for w in want if at + ends[0] <= w[0] < at + ends[-1]]
        at += r["ids"]
    assert "decode()" not in inspect.getsource(tokenfiles.read)
