"""The operators on Spark: against brute force on the smallest tables, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtab.llm import common, decontaminate, fingerprints, langid, neardup, packing, pii, registry, repeats, rollups, textops, tokenfiles, tokens, toxicity
from tests.helpers import duck, rows

DIR = "/root/testdata/sf0.001"


def test_scratch_tables(spark, monkeypatch):
    """Stored tables can be removed; a cluster without a shared folder is refused."""
    import os

    df = common.stored(spark.range(3).toDF("x"), "gone")
    path = common._STORED[df]
    assert df.count() == 3 and os.path.isdir(path)
    common.drop(df, spark.range(1))
    assert not os.path.exists(path)
    assert common.width(spark, spark.range(10)) == common.width(spark)
    monkeypatch.setattr(common, "PART_BYTES", 8)
    assert common.width(spark, spark.range(1000)) == 1000


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] or "" for r in common.documents(spark, DIR).collect()}


def got(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def components(texts: dict) -> dict:
    sets = {k: set(s.tolist()) for k, s in zip(texts, textops.shingles([(t or "").encode() for t in texts.values()]), strict=True)}
    root, seen = {k: k for k in texts}, defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in sets.items():
        shared = defaultdict(int)
        for h in s:
            for j in seen[h]:
                shared[j] += 1
            seen[h].append(k)
        for j, c in shared.items():
            if 100 * c >= 75 * (len(s) + len(sets[j]) - c):
                a, b = sorted((find(k), find(j)))
                root[b] = a
    return {k: (len(sets[k]), find(k)) for k in texts}


def test_op1(spark, docs):
    out = got(registry.queries()["op1_language_mixture"](spark, DIR))
    lang = {r["doc_id"]: r["lang"] for r in common.documents(spark, DIR).collect()}
    held = [k for k, r in out.items() if r["held_out"]]
    assert set(out) == set(docs) and all(out[k]["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k in out)
    assert sum(out[k]["lang_pred"] == lang[k] for k in held) / len(held) > 0.97


def plain_spans(t):
    """The base spans by the expressions as they are written, with nothing to make them fast."""
    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15],
    }


def test_op2(spark):
    texts = got(common.documents(spark, "/root/testdata/sf0.01", "doc_id", "text"))
    out = got(registry.queries()["op2_pii_skip_chain"](spark, "/root/testdata/sf0.01"))
    assert set(out) == set(texts)
    for k, r in texts.items():
        base = plain_spans(r["text"] or "")
        listed = ",".join(f"{x}:{s}:{e}" for x in pii.KINDS for s, e in base[x])
        assert out[k]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [out[k][f"n_{x}"] for x in pii.KINDS] == [len(base[x]) for x in pii.KINDS]
        assert set(listed.split(",")) <= set(out[k]["spans"].split(",")) and out[k]["n_spans"] == len([x for x in out[k]["spans"].split(",") if x])


def test_planted_mentions_are_found(spark):
    """The field learnt from the table finds mentions that are planted in its texts, and little else."""
    docs = common.documents(spark, "/root/testdata/sf0.01", "doc_id", "text")
    model = pii.train(docs)
    planted = found = wrong = 0
    for k, r in got(docs).items():
        t, true, _ = pii.plant(r["text"] or "", random.Random(k), 1.0)
        base = pii.base_spans(t)
        spans = [x for x in pii.all_spans(t, base, model) if (x[1], x[2]) not in base[x[0]]]
        true = [(pii.LABELS[x], s, e) for s, e, x in true if not any(a < e and b > s for own in base.values() for a, b in own)]
        hits = [x for x in spans if any(kind == x[0] and s < x[2] and e > x[1] for kind, s, e in true)]
        planted, found, wrong = planted + len(true), found + len(hits), wrong + len(spans) - len(hits)
    assert planted > 40 and found >= 0.9 * planted and wrong <= 0.1 * found, (planted, found, wrong)


def test_field_learns_from_distinct_texts(spark):
    """A text with very many copies takes one place in the sample, however small its hash."""
    rows = [(i, "tel +1 (228) 555-1624 and more words") for i in range(300)] + [(1000 + i, f"mail x{i}@y.org or {i} now") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(F.xxhash64("text").alias("h"), "text")
    kept = [r["text"] for r in common.smallest_distinct(df, "h", 40).collect()]
    assert len(set(kept)) == len(kept) and 30 <= len(kept) <= 40


def test_op3(spark, docs):
    out = got(registry.queries()["op3_bottom_k_fingerprints"](spark, DIR))
    order = sorted(docs, reverse=True)
    sets = dict(zip(docs, textops.shingles([t.encode() for t in docs.values()]), strict=True))
    for i, k in enumerate(order):
        following = order[(i + 1) % len(order)]
        edited = fingerprints._half(docs[k], docs[following])
        h = textops.shingles([edited.encode()])[0]
        assert out[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and out[k]["n_chars"] == len(docs[k])
        assert out[k]["fingerprint"] == fingerprints.to_text(sets[k][: fingerprints.K])
        union = len(np.union1d(h, sets[k]))
        true = len(np.intersect1d(h, sets[k])) / union if union else 1.0
        assert abs(out[k]["near_edited"] - true) < 0.2
        assert out[k]["near_next"] == fingerprints.resemblance(sets[k][: fingerprints.K], sets[following][: fingerprints.K])


def test_fingerprints_count_and_contain(spark):
    """Sets of fewer than K shingles are held whole, so counts and containments are exact."""
    texts = {1: " ".join(f"a{i}" for i in range(40)), 2: " ".join(f"b{i}" for i in range(60))}
    out = got(fingerprints.compare_with_next(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    for k, following in ((1, 2), (2, 1)):
        own, edited = (set(textops.shingles([t.encode()])[0].tolist()) for t in (texts[k], fingerprints._half(texts[k], texts[following])))
        assert out[k]["n_distinct"] == len(own)
        assert out[k]["edited_in_own"] == pytest.approx(len(own & edited) / len(edited)) and out[k]["own_in_edited"] == pytest.approx(len(own & edited) / len(own))


def test_op4(spark, docs):
    out = got(registry.queries()["op4_chosen_path_dedup"](spark, DIR))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in out.items()} == components(docs)
    assert all(r["kept"] == (k == r["component_id"]) for k, r in out.items())


def test_near_duplicates_in_large_groups(spark, monkeypatch):
    """Nodes and groups above their limits take the branching and the leader paths, with the same classes."""
    monkeypatch.setattr(neardup, "NODE_MAX", 4)
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 400)
    rng = np.random.default_rng(8)
    texts = {}
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(60)]
        for n in range(30):
            w = list(base)
            for _ in range(int(rng.integers(0, 3 if g else 9))):
                w[int(rng.integers(0, 60))] = f"r{rng.integers(0, 10**6)}"
            texts[g * 100 + n] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = got(neardup.components(df))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in out.items()} == components(texts)


def test_large_group_without_links(spark, monkeypatch):
    """Pages that share half their shingles part before any leader is used, and leaders are used many at a time."""
    monkeypatch.setattr(neardup, "NODE_MAX", 4)
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 400)
    monkeypatch.setattr(neardup, "LEADER_SHINGLES", 300, raising=False)
    tags, stored = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, tag: tags.append(tag) or stored(df, tag))
    menu = " ".join(f"menu{i}" for i in range(30))
    texts = {n: menu + " " + " ".join(f"p{n}w{i}" for i in range(20)) for n in range(20)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = got(neardup.components(df))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in out.items()} == components(texts)
    assert "members" in tags and tags.count("round") == 0
    # without the split, leaders settle the group in far fewer rounds than it has members
    monkeypatch.setattr(neardup, "_split", lambda large: large.drop("row"))
    texts |= {100 + n: texts[n] + " more" for n in range(4)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = got(neardup.components(df))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in out.items()} == components(texts)
    assert 0 < tags.count("round") <= 6


def test_a_large_template_group(spark):
    """20,000 pages that share up to 70 % of their shingles, none linked, and near copies of some: all limits as they are."""
    rng = np.random.default_rng(3)
    pages, made = 20_000, 300
    template = [f"page{i}" for i in range(200)]
    texts = []
    for n in range(pages):
        k = int(200 * rng.uniform(0.55, 0.83))
        texts.append([*template[:k], *(f"d{n}w{i}" for i in range(200 - k))])
    copies = []
    for j in range(made):
        n = int(rng.integers(0, pages))
        w = list(texts[n])
        for _ in range(int(rng.integers(1, 6))):
            w[int(rng.integers(0, 200))] = f"x{j}y{rng.integers(0, 10**6)}"
        copies.append((n, w))
    words = [*texts, *(w for _, w in copies)]
    df = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(words)], "doc_id long, text string")
    out = {k: r["component_id"] for k, r in got(neardup.components(df)).items()}
    sets = {n: {tuple(words[n][i : i + 5]) for i in range(196)} for n in {n for n, _ in copies} | set(range(pages, pages + made))}
    linked = [(n, pages + j) for j, (n, _) in enumerate(copies) if 100 * len(sets[n] & sets[pages + j]) >= 75 * len(sets[n] | sets[pages + j])]
    assert len(linked) > made // 2
    missed = [p for p in linked if out[p[0]] != out[p[1]]]
    assert not missed
    assert len(set(out.values())) == pages + made - len(linked)


def library(name):
    """The tokenizers library as it is, with a file of its own."""
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokens.resolve(name))
    return lambda t: np.array(fresh.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_op5(spark, docs):
    meta = {r["doc_id"]: (r["source"], r["lang"]) for r in common.documents(spark, DIR, "doc_id", "source", "lang").collect()}
    want = defaultdict(lambda: [0, 0])
    for version in rollups.VERSIONS:
        encode = library(f"{version}.json")
        for k, t in docs.items():
            want[*meta[k], version][0] += 1
            want[*meta[k], version][1] += len(encode(t)) // 4
    out = registry.queries()["op5_token_rollups"](spark, DIR).collect()
    assert {(r["source"], r["lang"], r["version"]): [r["n_docs"], r["n_tokens"]] for r in out} == dict(want) and len(out) == len(want)


def test_ledger_of_words(spark):
    df = registry.queries()["ledger_of_words"](spark, DIR)
    want = duck(DIR).sql(registry.oracle_sql()["ledger_of_words"])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_ledger_is_idempotent(spark):
    ledger = rollups.Ledger(spark, common.new_path(spark, "t"))
    event = lambda *r: spark.createDataFrame(list(r), rollups.EVENT)
    total = lambda: {(r["source"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}
    assert ledger.totals().count() == 0
    first = event(("insert", 1, "a", "en", "v", 5, 0), ("insert", 2, "a", None, "v", 7, 0), ("insert", 3, None, "en", "v", 1, 0), ("insert", 1, "a", "en", "v", 5, 0))
    assert ledger.commit(10, first) and not ledger.commit(10, first)
    assert total() == {("a", "v"): (1, 5), (None, "v"): (1, 1)} or total()[None, "v"] == (1, 1)
    assert ledger.totals().agg(F.sum("n_tokens")).first()[0] == 13
    assert ledger.commit(4, event(("revise", 1, "b", "en", "v", 9, 0), ("delete", 2, None, None, "v", 0, 0), ("delete", 99, "a", "en", "v", 3, 0), ("revise", 3, None, "en", "v", 2, 1), ("delete", 3, None, "en", "v", 2, 0)))
    assert total() == {("b", "v"): (1, 9), (None, "v"): (1, 2)}
    ledger.compact()
    assert total() == {("b", "v"): (1, 9), (None, "v"): (1, 2)} and not ledger.commit(10, first)
    assert ledger.commit(5, event()) and ledger.commit(6, event(("insert", 2, "a", "en", "v", 4, 0)))
    assert total()["a", "v"] == (1, 4) and not ledger.commit(4, first)
    n = rollups.count_tokens(spark.createDataFrame([("hello world",), (None,)], "text string"), "byte_bpe_50k.json").collect()
    assert [r["n_tokens"] for r in n] == [2, 0]
    both = spark.createDataFrame([(1, "hello  World, ça", "x"), (2, None, "y"), (3, "", "z")], "id long, text string, byte_bpe_50k string")
    both = rollups.count_by_versions(both, {v: f"{v}.json" for v in rollups.VERSIONS}, keep_text=False)
    sizes = [len(library(f"{v}.json")("hello  World, ça")) // 4 for v in rollups.VERSIONS]
    assert both.columns == ["id", *rollups.VERSIONS] and sorted(map(tuple, both.collect())) == [(1, *sizes), (2, 0, 0), (3, 0, 0)]


def test_ledger_against_random_histories(spark):
    """Every total after every commit, by plain dictionaries; replays, empty batches, null ids and compactions among them."""
    rng = random.Random(11)
    for turn in range(2):
        ledger, state, done = rollups.Ledger(spark, common.new_path(spark, "t")), {}, {}
        for batch in [3, 1, 3, 7, 2, 7, 9, 4]:
            made = [(rng.choice(["insert", "delete", "revise"]), rng.choice([None, *range(12)]), rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]), rng.choice([None, *range(9)]), i) for i in range(rng.choice([0, 10, 30]))]
            assert ledger.commit(batch, spark.createDataFrame(made, rollups.EVENT)) == (batch not in done)
            if batch not in done:
                last = {(r[1], r[4]): r for r in sorted(made, key=lambda r: r[6])}
                for key, (op, _, source, lang, version, n, _) in last.items():
                    if op == "delete":
                        state.pop(key, None)
                    else:
                        state[key] = (source, lang, version, n or 0)
                done[batch] = True
            want = defaultdict(lambda: [0, 0])
            for source, lang, version, n in state.values():
                want[source, lang, version][0] += 1
                want[source, lang, version][1] += n
            assert {(r["source"], r["lang"], r["version"]): [r["n_docs"], r["n_tokens"]] for r in ledger.totals().collect()} == dict(want)
            if batch == 7 and turn:
                ledger.compact()


def test_commits_that_fail_or_meet(spark, tmp_path):
    ledger = rollups.Ledger(spark, str(tmp_path / "l"))
    one = spark.createDataFrame([("insert", 1, "a", "en", "v", 5, 0)], rollups.EVENT)
    mark = ledger._mark
    ledger._mark = lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        ledger.commit(1, one)
    ledger._mark = mark
    assert ledger.totals().count() == 0 and ledger.commit(1, one) and ledger.totals().first()["n_tokens"] == 5
    ledger._next = lambda: 0  # another commit took the place meanwhile
    with pytest.raises(Exception, match="exist"):
        ledger.commit(2, one)
    del ledger._next
    assert ledger.committed() == [1] and ledger.commit(2, one) and ledger.totals().first()["n_docs"] == 1
    (tmp_path / "l" / "commits" / "000000000002.json").write_text("")  # a marker that was never filled
    assert ledger.committed() == [1, 2] and ledger.commit(3, one) and ledger.committed() == [1, 2, 3]


def test_odd_rollups(spark, odd, empty, tmp_path):
    numbered = odd.select(F.monotonically_increasing_id().alias("doc_id"), "source", "lang", "text", *[c for c in odd.columns if c not in ("doc_id", "source", "lang", "text")])
    counted = rollups.count_tokens(numbered.withColumn("n_tokens", F.lit("clash")), "byte_bpe_50k.json")
    assert dict(counted.dtypes)["n_tokens"] == "bigint" and counted.columns.count("n_tokens") == 1
    ledger = rollups.Ledger(spark, common.new_path(spark, "t"))
    assert ledger.commit(1, rollups.events(counted, "insert", "v", F.col("n_tokens"))) and ledger.commit(2, rollups.events(empty, "delete", "v", F.lit(1)))
    encode = library("byte_bpe_50k.json")
    assert ledger.totals().agg(F.sum("n_docs"), F.sum("n_tokens")).first() == (odd.count(), sum(len(encode(r["text"] or "")) // 4 for r in odd.select("text").collect()))
    for name, df in (("odd", odd), ("empty", empty)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = registry.queries()["op5_token_rollups"](spark, f"{tmp_path}/{name}")
        assert (out.groupBy("version").agg(F.sum("n_docs").alias("n")).where(F.col("n") != df.count()).count(), out.count() > 0) == (0, name == "odd")


def test_rollups_of_null_and_repeated_ids(spark, tmp_path):
    rows = [(1, "word " * 60, "en", "s"), (1, "word " * 60, "en", "s"), (1, "other " * 70, "en", "s"), (None, "word " * 60, "en", "s"), (None, "word " * 80, "de", None), (2, "short", "en", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    df = registry.queries()["ledger_of_words"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(registry.oracle_sql()["ledger_of_words"])
    as_rows = lambda data: sorted(map(str, map(tuple, data)))
    assert as_rows(df.select(*want.columns).collect()) == as_rows(want.fetchall())


def test_op6(spark, docs):
    out = registry.queries()["op6_best_fit_packing"](spark, DIR).collect()
    encode = library(packing.VOCABULARY)
    pieces, bins = defaultdict(dict), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]][r["piece"]] = r
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, t in docs.items():
        b = encode(t) + (1).to_bytes(4, "little")
        own = [pieces[k][i] for i in range(len(pieces[k]))]
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in own] == [(s // 4, len(b[s : s + 16384]) // 4, zlib.crc32(b[s : s + 16384])) for s in range(0, len(b), 16384)]
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    said = packing.certificate(spark.createDataFrame(out)).first()
    assert said["bound"] <= said["sequences"] == len(bins) <= said["bound"] + 1


def test_exchange_saves_bins(spark):
    items = spark.createDataFrame([(i, 0, 0, 1 + i * 37 % 70, 0) for i in range(400)], packing.PIECES)
    alone = packing.pack(items, 100, part_pieces=20, rounds=0)
    together = packing.pack(items, 100, part_pieces=20)
    count = lambda df: df.select("sequence_id").distinct().count()
    assert together.count() == 400 and count(together) < count(alone)
    assert together.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 100").count() == 0


def test_op7(spark, docs):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()}
    flat = lambda t: " ".join(t.lower().split())
    want = {(k, i) for k, t in docs.items() for i, x in items.items() if flat(x) in flat(t)}
    found = registry.queries()["op7_qgram_decontamination"](spark, DIR).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["distance"] == 0} == want
    assert all(flat(docs[r["doc_id"]][r["start"] : r["end"]]) == flat(items[r["item_id"]]) for r in found if r["distance"] == 0)


def test_op8(spark, docs):
    out = got(registry.queries()["op8_token_id_files"](spark, DIR))
    encode, at = library(tokenfiles.VOCABULARY), 0
    for k in sorted(docs):
        b = encode(docs[k]) + bytes(4)
        assert (out[k]["start"], out[k]["n_tokens"], out[k]["ids_crc32"]) == (at, len(b) // 4, zlib.crc32(b))
        at += len(b) // 4


def test_shard_select(spark):
    df = spark.createDataFrame([(5, "a b"), (9, ""), (None, "x"), (7, None)], "doc_id long, text string").coalesce(1)
    manifest = tokenfiles.write(df, common.new_path(spark, "ids")).orderBy("shard").collect()
    shards = [tokenfiles.Shard(r["folder"], r["file"]) for r in manifest]
    seen = [(s.doc_id(i), s.ids(*s.span(i)).tolist()) for s in shards for i in range(s.documents)]
    ids = lambda t: np.frombuffer(tokens.encoder(tokenfiles.VOCABULARY)._encode([t])[0], "<u4").tolist() if t else []
    assert seen == [(None, [*ids("x"), 0]), (5, [*ids("a b"), 0]), (7, [0]), (9, [0])]


def test_shards_of_many_parts(spark, monkeypatch, tmp_path):
    """Small limits give several parts a shard; places count over all of them, select finds each document, leftovers go."""
    monkeypatch.setattr(tokenfiles, "SHARD_DOCS", 7)
    texts = {i: "word " * (i % 5) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    folder = tmp_path / "ids"
    folder.mkdir()
    (folder / "shard-000000-0000-dead.part").write_bytes(b"half")
    manifest = tokenfiles.write(df, str(folder))
    names = {r["file"] for r in manifest.collect()}
    assert {str(x) for x in folder.iterdir() if not x.name.startswith(".")} == names and len(names) > 8
    encode, at = library(tokenfiles.VOCABULARY), 0
    out = got(tokenfiles.read(manifest))
    for k, t in texts.items():
        n = len(encode(t)) // 4 + 1
        assert (out[k]["start"], out[k]["n_tokens"]) == (at, n)
        at += n
    seen = [s.doc_id(i) for r in manifest.orderBy("shard", "part").collect() for s in [tokenfiles.Shard(r["folder"], r["file"])] for i in range(s.documents)]
    assert seen == sorted(texts)


def kept(texts: dict) -> dict:
    seen, out = set(), {}
    for k, b in texts.items():
        gone = bytearray(len(b))
        for o in range(len(b) - 99):
            w = b[o : o + 100]
            if w in seen:
                gone[o : o + 100] = b"\1" * 100
            seen.add(w)
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def test_op9(spark, docs):
    out = got(registry.queries()["op9_suffix_bucket_dedup"](spark, DIR))
    assert {k: tuple(r)[1:] for k, r in out.items()} == kept({k: docs[k].encode() for k in sorted(docs)})


def test_hot_and_periodic_repeats(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 5)
    line = "the same passage of more than one hundred bytes that very many documents share, word for word, over and over again "
    texts = {i: (f"head {i} " * (i % 3)) + line + f"tail {i * i}" + ("ab" * 150 if i % 5 == 0 else "") + ("z" * 130 if i % 7 == 0 else "") for i in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = got(repeats.remove(df))
    assert {k: tuple(r)[1:] for k, r in out.items()} == kept({k: t.encode() for k, t in texts.items()})


def test_hot_anchor_in_texts_that_differ(spark, monkeypatch):
    """What passes on from a hot bucket spreads: no key of the second pass gets more rows than there were deals."""
    monkeypatch.setattr(repeats, "HOT", 10)
    passed, stored = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, tag: passed.append(stored(df, tag)) or passed[-1] if tag == "thin" else stored(df, tag))
    line = "License: to be used as it is, without warranty. "
    texts = {i: " ".join(str((i + 3) ** k % 999983) for k in range(2, 20)) + line + " ".join(str((i % 50 + 7) ** k % 999979) for k in range(2, 20)) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = got(repeats.remove(df))
    assert {k: tuple(r)[1:] for k, r in out.items()} == kept({k: t.encode() for k, t in texts.items()})
    key = [c for c in ("hash", "w", "v") if c in passed[0].columns]
    most = passed[0].where("spans is null").groupBy(*key).count().agg(F.max("count")).first()[0]
    assert most <= 6


def test_op10(spark):
    out = got(registry.queries()["op10_toxicity_mil"](spark, "/root/testdata/sf0.01"))
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [k for k in labels if out[k]["held_out"]]
    assert all(out[k]["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) and out[k]["predicted"] == int(out[k]["score"] >= 0.5) for k in out)
    assert sum(out[k]["predicted"] == labels[k] for k in held) / len(held) > 0.95


# odd rows


def test_odd_languages(odd, empty):
    model = langid.train(odd)
    assert langid.train(empty).languages == ()
    out = langid.predict(odd, model)
    assert out.count() == odd.count() and {r["lang_pred"] for r in out.where("doc_id in (1, 2, 3)").collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0 and langid.predict(odd, langid.train(empty)).where("lang_pred <> 'und'").count() == 0


def test_odd_personal_data(odd, empty):
    weights = pii.train(odd)
    assert isinstance(weights, pii.FieldModel) and pii.find(odd, weights).count() == odd.count() and pii.find(empty, pii.train(empty)).count() == 0
    assert sorted(map(str, pii.mask(odd, weights).collect())) == sorted(map(str, odd.collect()))


def test_odd_fingerprints(odd, empty):
    out = fingerprints.compare_with_next(odd)
    assert out.count() == odd.where("doc_id is not null").count() and fingerprints.compare_with_next(empty).count() == 0
    assert fingerprints.fingerprint(odd).where("doc_id in (1, 2, 3) and fingerprint <> ''").count() == 0
    parts = fingerprints.merged(fingerprints.fingerprint(odd).withColumn("g", F.lit(1)), "g").first()["fingerprint"]
    hashes = textops.shingles([(r["text"] or "").encode() for r in odd.collect()])
    assert parts == fingerprints.to_text(fingerprints.merge(hashes))


def test_odd_near_duplicates(odd, empty):
    out = neardup.components(odd)
    classes = {(r["doc_id"], r["component_id"]) for r in out.collect()}
    assert classes == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (8, 6), (9, 9), (10, 5), (11, 4), (None, None)}
    assert neardup.components(empty).count() == 0
    stay = neardup.keep_one(odd)
    assert stay.columns == odd.columns and sorted(r["doc_id"] or 0 for r in stay.collect()) == [0, 1, 2, 3, 4, 5, 6, 9]


def test_odd_packing(odd, empty):
    out = packing.pack(packing.pieces(odd))
    assert out.select("doc_id").distinct().count() == 12 and out.where("doc_id = 1").first()["length"] == 1
    assert packing.pack(packing.pieces(empty)).count() == 0 and packing.certificate(out.limit(0)).first()["bound"] == 0


def test_odd_decontamination(spark, odd, empty):
    bench = spark.createDataFrame([(1, "kappa lambda mu nu xi omicron"), (2, None), (3, "short"), (4, "kappa lambda mu nu xi omicron"), (5, "")], "item_id int, text string")
    out = decontaminate.find(odd, bench)
    assert sorted((r["doc_id"], r["item_id"]) for r in out.collect()) == sorted((k, i) for k in (6, 7, 7, 8) for i in (1, 4))
    stay = decontaminate.keep_clean(odd, bench)
    assert stay.columns == odd.columns and stay.count() == odd.count() - 4
    assert decontaminate.find(empty, bench).count() == decontaminate.find(odd, bench.limit(0)).count() == 0
    assert decontaminate.keep_clean(odd, bench.limit(0)).count() == odd.count()


def test_odd_token_files(spark, odd, empty):
    out = tokenfiles.read(tokenfiles.write(odd, common.new_path(spark, "ids")))
    assert out.count() == odd.count() and out.where("doc_id = 1 and n_tokens = 1").count() == 1
    assert tokenfiles.read(tokenfiles.write(empty, common.new_path(spark, "ids"))).count() == 0


def test_odd_repeats(odd, empty):
    out = {r["doc_id"]: r for r in repeats.remove(odd).collect()}
    assert out[1]["n_bytes"] == out[2]["n_removed"] == 0 and out[10]["n_removed"] >= len(out[5].__str__()) and out[7]["n_removed"] == out[6]["n_bytes"]
    assert repeats.remove(odd).count() == odd.count() and repeats.remove(empty).count() == 0


def test_odd_toxicity(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1), (6, 1), (9, 0), (5, None), (77, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    scored = toxicity.score(odd, model)  # its own column of that name is replaced
    assert sorted(scored.columns) == sorted(odd.columns) and scored.where("score between 0 and 1").count() == odd.count()
    assert toxicity.train(odd, labels, fit_words=1).labelled == 1
    stay = toxicity.keep_clean(odd, model)
    assert stay.columns == odd.columns
    assert toxicity.train(odd, labels.limit(0)).labelled == 0 and toxicity.score(empty.drop("score"), model).count() == 0
    assert toxicity.offending_sentences(odd, model).columns == ["doc_id", "sentence", "start", "end", "score"]


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(6, 1), (9, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "kappa lambda mu nu xi omicron")], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = common.documents(spark, str(tmp_path))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == odd.columns
    assert docs.where("doc_id in (6, 7, 8)").count() == 0 and docs.where("doc_id in (1, 2, 9)").count() == 3
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= docs.count()


def test_pipeline_stages_one_by_one(spark, docs):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    start = common.documents(spark, DIR)
    after = [start]
    for _, stage in corpus_pipeline.STAGES:
        after.append(common.stored(stage(spark, after[-1], DIR), "stage"))
    ids = [{r["doc_id"] for r in df.select("doc_id").collect()} for df in after]
    texts = [{r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()} for df in after[:-1]]
    labels = spark.read.parquet(f"{DIR}/labels.parquet").where(common.crc_mod("doc_id", 5) != 0)
    model = toxicity.train(start, labels)
    assert ids[1] == {k for k, t in texts[0].items() if toxicity.score_texts(model, [(t or "").encode()])[0] < 0.5}
    assert ids[2] == {k for k, (_, c) in components(texts[1]).items() if c == k}
    bench = decontaminate.Items.of(*zip(*[(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()], strict=True))
    assert ids[3] == {k for k, t in texts[2].items() if not decontaminate.matches(bench, t or "")}
    assert ids[4] == ids[3] == ids[5] and not any(any(pii.base_spans(t or "").values()) for t in texts[4].values())
    assert sum(texts[4][k] != texts[3][k] for k in ids[4]) == sum(any(pii.base_spans(t or "").values()) for t in texts[3].values())
