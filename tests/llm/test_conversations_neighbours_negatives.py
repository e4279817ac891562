"""Operators 11 to 13: against SQL and plain Python on the smallest tables, and on odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtab.llm import common, hardnegatives, neighbours, prefixtrie, registry
from tests.helpers import duck, rows

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_multi_index_negatives"])
def test_same_rows_as_sql(spark, name):
    df, found = registry.queries()[name](spark, DIR), duck(DIR).sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(found.columns, found.fetchall())


# 11: prefix trie


def plain_trie(table):
    """The nodes by dictionaries of whole prefixes. table: (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, r, x in table:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append(((t is not None, t or 0), hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    convs = {c: [(r, x) for *_, r, x in sorted(v, key=lambda y: y[:2])] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h, donor = zlib.crc32(str(c).encode()) % 4, c - c % 20
        rebuilt[c] = own if donor == c else convs.get(donor, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    words = lambda x: len([w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in x).split(" ") if w])
    own = {p: (len(m) - 1) * words(p[-1][1]) if p else 0 for p, m in members.items()}
    out = {}
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in m if len(rebuilt[c]) == len(p))
        out[(min(m), len(p))] = (min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in below), sum(own[q] for q in below), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def spark_trie(spark, table):
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").withColumns({"k1": F.lit(1), "depth": F.lit("x"), "digest": F.lit(None)})
    hashed = prefixtrie.turns(df)
    convs, rebuilt = prefixtrie.rebuild(prefixtrie.number(hashed.drop("role", "text")))
    nodes = prefixtrie.trie(convs, rebuilt)
    return nodes, rebuilt, hashed


def test_trie_of_random_conversations(spark):
    """Shared openings, copies, prefixes of others, nulls, ties and repeated rows, turnless and missing donors."""
    rng = random.Random(5)
    table = []
    for c in [*range(40), 45, 61, 62, 63, 87]:
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            table.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", "bot", None]), rng.choice(["a", "a b", "a  b\tc", "", None, "ü x"])))
    table += [table[3]] * 2 + [(None, 0, "user", "nobody's")]
    nodes, *_ = spark_trie(spark, table)
    got = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in nodes.collect()}
    assert got == plain_trie(table)


def test_trie_of_one_long_and_many_equal_conversations(spark, monkeypatch):
    """A conversation with a third of all rows, and a third of equal ones; lists of ends in many pieces."""
    monkeypatch.setattr(prefixtrie, "CHUNK_IDS", 7)
    table = [(20_000_000, i, "user", f"word {i % 5}") for i in range(600)] + [(20 * i, t, "bot", f"same {t}") for i in range(300) for t in range(2)] + [(20 * i + 1, 0, "user", f"own {i}") for i in range(600)]
    nodes, rebuilt, hashed = spark_trie(spark, table)
    got = {(r["conv_id"], r["depth"]): r for r in prefixtrie.last_turns(nodes, rebuilt, hashed).collect()}
    same = got[(0, 2)]
    ends = sorted({20 * i for i in range(300)})
    assert same["n_convs"] >= 300 and got[(0, 0)]["parent_conv_id"] is None and got[(0, 0)]["role"] is None
    assert max(d for _, d in got) == 600 and got[(20_000_000, 600)]["text"] == "word 4" and got[(20_000_000, 600)]["n_leaves"] == 1
    alone = [c for c in ends if len({x for x in table if x[0] == c}) == 2]
    assert same["ends_sha256"] != hashlib.sha256(b"").hexdigest() and len(alone) == 300
    assert {k: r["ends_sha256"] for k, r in got.items() if k[0] == 0} == {k: v[-1] for k, v in plain_trie(table).items() if k[0] == 0}


def test_no_conversations(spark):
    nodes, *_ = spark_trie(spark, [])
    assert nodes.count() == 0 and nodes.columns == list(prefixtrie.NODE_COLUMNS)


# 12: quality by neighbours


def test_quality_of_held_out_documents(spark):
    dir_ = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in registry.queries()["op12_neighbour_quality"](spark, dir_).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{dir_}/labels.parquet").collect()}
    assert set(out) == {r["doc_id"] for r in common.documents(spark, dir_).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for k, r in out.items())
    held = [k for k in labels if out[k]["held_out"]]
    poor = [k for k in held if labels[k] == 0]
    assert sum(out[k]["predicted"] == labels[k] for k in held) / len(held) > 0.97 and sum(out[k]["predicted"] == 0 for k in poor) >= 0.9 * len(poor)


def test_votes_equal_a_plain_loop():
    """Blocked products over all voters against a sort of all cosines, ties at the last place included."""
    rng = np.random.default_rng(1)
    vectors = neighbours._unit(rng.standard_normal((5000, 8)).astype(np.float32))
    vectors[4000:4100] = vectors[0]
    labels = rng.integers(0, 2, 5000).astype(np.float32)
    model = neighbours.QualityModel(np.ones(neighbours.FEATURES, np.float32), np.zeros((neighbours.FEATURES, 8), np.float32), vectors, labels, 0.5, 0.5)
    x = np.concatenate((vectors[:3], neighbours._unit(rng.standard_normal((40, 8)).astype(np.float32)), np.zeros((1, 8), np.float32)))
    for v, got in zip(x, neighbours.vote(x, model), strict=True):
        near = (vectors.astype(float) @ v.astype(float)).tolist()
        least = sorted(near, reverse=True)[neighbours.NEIGHBOURS - 1] - neighbours.TIE
        voters = [(max(0, s) ** neighbours.SHARPNESS, y) for s, y in zip(near, labels.tolist(), strict=True) if s >= least]
        total = sum(w for w, _ in voters)
        assert got == pytest.approx(sum(w * y for w, y in voters) / total if total else 0.5, abs=2e-3)


def test_latent_space_spans_the_rows():
    """Rows of rank three are kept whole by three directions."""
    rng = np.random.default_rng(2)
    basis = rng.standard_normal((3, 50))
    data = [(np.arange(100, 150), (rng.standard_normal(3) @ basis).astype(np.float32)) for _ in range(300)]
    directions = neighbours.latent(data, 3)
    for f, v in data[:20]:
        assert np.linalg.norm(v @ directions[f]) == pytest.approx(np.linalg.norm(v), rel=1e-4)


def test_features_by_plain_words():
    """Counts of a text do not depend on its neighbours in a batch, and repetition is told from news."""
    texts = [b"", b"one two two one THREE!!", b" \t", "Ünïcödé wörd ###".encode(), b"x " * 5000]
    doc, feature, n = neighbours.counts(texts)
    for i, t in enumerate(texts):
        own = neighbours.counts([t])
        assert own[1].tolist() == feature[doc == i].tolist() and own[2].tolist() == n[doc == i].tolist()
    told = {i: dict(zip(feature[doc == i].tolist(), n[doc == i].tolist(), strict=True)) for i in (1, 4)}
    assert told[1][0] == 3 and told[1][1] == 2 and told[1][2] == 1 and told[4][0] == 1 and told[4][1] == 4999 and told[4][2] == 4999


def test_odd_quality(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (5, 1), (6, 1), (7, 1), (8, None), (99, 1), (None, 0)], "doc_id long, quality int")
    model = neighbours.train(odd, labels)
    assert model.bare == 0.0 and len(model.labels) == 2  # the copies of one text are one voter
    out = neighbours.score(odd, model)
    assert out.count() == odd.count() and out.columns == [c for c in odd.columns if c != "score"] + ["score"]
    found = {r["doc_id"]: r["score"] for r in out.collect()}
    assert found[1] == found[2] == found[3] == 0.0 and found[6] == found[7] == 1.0
    assert neighbours.score(empty, model).count() == 0
    unlabelled = neighbours.train(odd, labels.limit(0))
    assert {r["score"] for r in neighbours.score(odd, unlabelled).collect()} == {0.5} and neighbours.train(empty, labels).share == 0.5


# 13: hard negatives


def plain_negatives(table, every=100):
    out = set()
    rows_ = [(i, c, lab, v) for i, (c, lab, v) in enumerate(table)]
    for i, c, lab, v in rows_:
        if c % every:
            continue
        score = lambda w: sum(a * b for a, b in zip(v, w, strict=False))
        others = sorted(((-score(w), d, m) for j, d, m, w in rows_ if j != i), key=lambda x: x[:2])
        for s, d, _ in [x for x in others if x[2] == lab][:5]:
            fit = [x for x in others if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out |= {(c, d, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit)}
    return out


def found_negatives(spark, table, **how):
    df = spark.createDataFrame(table, "vec_id long, label long, vec array<long>")
    return [tuple(r) for r in hardnegatives.mine(df, **how).collect()]


def clustered(n, seed, dims=6, scale=40):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(dims)] for _ in range(12)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, rng.randrange(3), [int(x + rng.gauss(0, scale / 8)) for x in c]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_by_brute_force(spark, monkeypatch, seed):
    """Many small cells and shelves, short probes, groups of a few anchors: the visits that the bounds certify lose nothing."""
    for name, value in (("CELL_ROWS", 4), ("SHELF_ROWS", 25), ("PROBE_ROWS", 20), ("GROUP_ANCHORS", 3)):
        monkeypatch.setattr(hardnegatives, name, value)
    table = clustered(700, seed) + [(100, 1, [3, -3])] + [(5000 + i, 2, [9, 9, 9, 0, 0, 1]) for i in range(80)]
    got = found_negatives(spark, table, every=20)
    assert set(got) == plain_negatives(table, 20) and len(got) > 500


def test_cells_are_left_unseen(spark, monkeypatch):
    """On clustered vectors the certified search looks into few cells, by falling bounds that no row exceeds."""
    for name, value in (("CELL_ROWS", 4), ("PROBE_ROWS", 20)):
        monkeypatch.setattr(hardnegatives, name, value)
    table = clustered(2000, 3, scale=400)
    frame, book = hardnegatives.index(spark.createDataFrame(table, "vec_id long, label long, vec array<long>"))
    cells = {r["vec_id"]: r["cell"] for r in frame.collect()}
    by_cell = defaultdict(list)
    for i, _, v in table:
        by_cell[cells[i]].append(v)
    looked = 0
    for _, _, v in table[:20]:
        q = np.array(v, float)
        walked = list(book.walk(q))
        assert {c for *_, c in walked} == set(by_cell) and [b for b, *_ in walked] == sorted((b for b, *_ in walked), reverse=True)
        for bound, least, c in walked:
            assert all(least <= float(q @ np.array(w)) <= bound for w in by_cell[c])
        best = sorted((float(q @ np.array(w)) for _, _, w in table), reverse=True)[5]
        looked += len(book.visits(q, [-hardnegatives.FAR], [hardnegatives.FAR], [int(best)])) / len(walked)
    assert looked / 20 < 0.3


def test_odd_negatives(spark):
    """Null ids, labels, vectors and components, infinities, copies, empty vectors, large components; no rows, one row, no anchor."""
    bad = [(None, 1, [1.0]), (100, None, [1.0]), (200, 1, None), (300, 1, [1.0, None]), (400, 1, [float("nan")]), (500, 1, [float("inf")])]
    good = [(0, 0, [0.5, 0.25]), (0, 0, [0.5, 0.25]), (1, 0, [0.5]), (2, 1, [0.25, 0.1]), (3, 1, []), (4, 1, [0.3, -0.001]), (600, 1, [1e6, -1e6])]
    df = spark.createDataFrame(bad + good, "vec_id long, label int, embedding array<double>").withColumns({c: F.lit(1) for c in ("vec", "cell", "shelf", "rid", "k", "anchor")})
    taken = hardnegatives.vectors(df)
    assert taken.count() == len(good)
    table = [(r["vec_id"], r["label"], r["vec"]) for r in taken.collect()]
    assert (4, 1, [76, -1]) in table
    got = [tuple(r) for r in hardnegatives.mine(taken).collect()]
    pad = [(c, lab, v + [0] * (2 - len(v))) for c, lab, v in table]
    assert set(got) == plain_negatives(pad)
    assert found_negatives(spark, []) == [] and found_negatives(spark, [(100, 1, [1, 2])]) == [] and found_negatives(spark, [(1, 1, [1]), (2, 2, [1])]) == []
    huge = [(100, 1, [1 << 28, 3]), (101, 1, [1 << 30, 5]), (102, 2, [1 << 29, 7])]
    assert set(found_negatives(spark, huge)) == plain_negatives(huge) and len(plain_negatives(huge)) == 1
