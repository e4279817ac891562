"""The array kernels against plain Python."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomtab.llm import decontaminate, fingerprints, langid, neardup, packing, pii, repeats, textops, tokens, toxicity
from loomtab.llm.eliasfano import EliasFano

words = st.lists(st.sampled_from(["a", "B", "c.", "é", "longer", "x1"]), max_size=30).map(" ".join)


@given(st.lists(words, max_size=8))
@settings(max_examples=60, deadline=None)
def test_shingles(texts):
    def plain(t):
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t).split(" ") if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    got = textops.shingles([t.encode() for t in texts])
    sets = [plain(t) for t in texts]
    assert [len(g) for g in got] == [len(s) for s in sets]
    for g, s in zip(got, sets, strict=True):
        for h, u in zip(got, sets, strict=True):
            assert len(np.intersect1d(g, h)) == len(s & u)


@given(st.lists(st.integers(0, 10_000), max_size=600))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values):
    values = sorted(values)
    code = EliasFano.from_bytes(EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert code.decode().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        code.select(len(values))


def test_elias_fano_in_blocks(monkeypatch):
    from loomtab.llm import eliasfano

    monkeypatch.setattr(eliasfano, "BLOCK", 16)
    values = np.cumsum(np.random.default_rng(2).integers(0, 5000, 333))
    code = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    assert code.decode().tolist() == values.tolist() == [code.select(i) for i in range(333)]


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    assert len(EliasFano.of(values).to_bytes()) * 8 <= len(values) * (2.3 + math.log2(values[-1] / len(values)) + 1)
    with pytest.raises(ValueError):
        EliasFano.of(np.array([3, 2]))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoding_in_pieces_is_encoding_whole(name):
    e = tokens.Encoder(name)
    random.seed(5)
    letters = "abÉ.,'s \n\t ́İσΣ12²ª\x1c日ñ!?-@"
    texts = ["", "  x", "don't stop. Now,", "<|endoftext|> a", *("".join(random.choices(letters, k=random.randint(1, 30))) for _ in range(3000))]
    assert [e.encode(t) for t in texts] == e._encode(texts)
    e.cache.clear()
    assert e.encode("same words same words") == e._encode(["same words same words"])[0]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_are_those_of_the_library(name):
    """Against a tokenizer loaded afresh from the file, on texts that hold the added tokens' contents, whole and in part."""
    from tokenizers import Tokenizer

    fresh, e = Tokenizer.from_file(tokens.resolve(name)), tokens.Encoder(name)
    rng = random.Random(3)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "a", "É", ".,", "'s", "\n", "ſ", "K", "<", "|", ">", "日", "1"]
    texts = ["a <|endoftext|> b", *("".join(rng.choices(bits, k=rng.randint(1, 9))) for _ in range(5000))]
    for t in texts:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == fresh.encode(t, add_special_tokens=False).ids, t
    assert fresh.token_to_id("<|endoftext|>") in np.frombuffer(e.encode(texts[0]), "<u4").tolist()


@given(st.lists(st.integers(1, 100), min_size=1, max_size=9))
@settings(max_examples=80, deadline=None)
def test_packing_bound_and_bins(sizes):
    sizes = np.array(sorted(sizes, reverse=True))

    def fewest(i, free):  # exhaustive, with equal bins tried once
        if i == len(sizes):
            return len(free)
        options = [fewest(i + 1, free + (100 - int(sizes[i]),))]
        for room in set(free):
            if room >= sizes[i]:
                rest = list(free)
                rest.remove(room)
                options.append(fewest(i + 1, (*rest, room - int(sizes[i]))))
        return min(options)

    bins, offsets, used = packing.best_fit(sizes, 100)
    least = fewest(0, ()) if len(sizes) <= 7 else used
    assert packing.lower_bound(sizes, 100) <= least <= used
    assert np.bincount(bins, sizes).max() <= 100
    for b in range(used):
        own = np.flatnonzero(bins == b)
        assert offsets[own].tolist() == [0, *np.cumsum(sizes[own])[:-1].tolist()]


def test_alignment_against_brute_force():
    random.seed(1)

    def distance(a, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        return min(row)

    letters = "abcde fghij"
    for _ in range(60):
        item = " ".join("".join(random.choices(letters, k=random.randint(40, 130))).split())
        c = list(item)
        for _ in range(random.randint(0, int(len(c) * 0.12))):
            p = random.randrange(len(c))
            c[p : p + random.randint(0, 1)] = random.choices(letters, k=random.randint(0, 1))
        text = "".join(random.choices(letters, k=150)) + "".join(c) + "".join(random.choices(letters, k=100))
        found = decontaminate.matches(decontaminate.Items.of([1], [item]), text)
        least = distance(item, "".join(map(chr, decontaminate.normal(text)[0])))
        assert bool(found) == (least <= decontaminate.budget(len(item)))
        if found:
            assert found[0][3] == least
            assert distance(item, " ".join(text[found[0][1] : found[0][2]].split())) == least


def _least(item, text):
    """Edit distance of the item to the nearest part of the text: the whole table, row by row."""
    row, step = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for i, x in enumerate(item, 1):
        new = np.empty(len(text) + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != x), row[1:] + 1)
        row = np.minimum.accumulate(new - step) + step
    return int(row.min())


@pytest.mark.parametrize("segment,hits", [(1 << 17, 1 << 21), (200, 50)])
def test_filter_loses_no_edited_passage(monkeypatch, segment, hits):
    """All items against all texts by full alignment; up to the budget and beyond it, edits are planted; also in small segments and blocks."""
    monkeypatch.setattr(decontaminate, "SEGMENT", segment)
    monkeypatch.setattr(decontaminate, "HITS", hits)
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("aabcdeé", k=rng.randint(1, 6)))
    items = {i: " ".join(word() for _ in range(rng.randint(3, 40))) for i in range(10)}
    items[10] = items[0] + " more"  # shares its q-grams with another
    texts = []
    for _ in range(25):
        parts = [word() for _ in range(rng.randint(0, 150))]
        for i in rng.sample(sorted(items), rng.randint(0, 3)):
            c, m = list(items[i]), len(items[i])
            for _ in range(rng.randint(0, decontaminate.budget(m) + 2)):
                p = rng.randrange(len(c))
                c[p : p + rng.randint(0, 1)] = rng.choices("xyz", k=rng.randint(0, 1))
            parts.insert(rng.randint(0, len(parts)), "".join(c))
        texts.append(" ".join(parts))
    table = decontaminate.Items.of(list(items), list(items.values()))
    seen = set()
    for n, t in enumerate(texts):
        flat = np.array([ord(c) for c in "".join(map(chr, decontaminate.normal(t)[0]))])
        want = {i: d for i, x in items.items() if (d := _least([ord(c) for c in " ".join(x.split())], flat)) <= decontaminate.budget(len(x))}
        got = {}
        for i, _, _, d in decontaminate.matches(table, t):
            got[i] = min(d, got.get(i, d))
        assert got == want, n
        seen |= {d for d in want.values()}
    assert len(seen) > 3


def test_short_items_are_found_as_whole_words():
    table = decontaminate.Items.of([1, 2, 3, 4], ["Yes.", "a  b", "", "yes."])
    assert [(i, s, e) for i, s, e, _ in decontaminate.matches(table, "yes. Ayes. A \n b, ab yes.x")] == [(1, 0, 4), (4, 0, 4), (2, 11, 16)]
    assert decontaminate.matches(table, "yes.", short=False) == []


def test_anchors_depend_on_the_window_alone():
    random.seed(2)
    reach = repeats.WINDOW - repeats.GRAM + 1
    for k in range(40):
        b = [bytes(random.choices(b"abcdefgh ", k=300)), b"a" * 250, b"abc" * 60 + bytes(random.choices(b"xyz", k=90)), bytes(random.choices(b"ab", k=7)) * 40][k % 4]
        h = textops.window_hashes(np.frombuffer(b, np.uint8), repeats.GRAM).tolist()
        want = [o + h[o : o + reach].index(min(h[o : o + reach])) for o in range(len(b) - repeats.WINDOW + 1)]
        hashes, first, last, _ = repeats._anchors(np.frombuffer(b, np.uint8))
        got = [x for x, i, j in zip(hashes.tolist(), first, last, strict=True) for _ in range(j - i + 1)]
        assert got == [h[p] for p in want]


def test_bucket_refinement():
    random.seed(3)
    data = bytes(random.choices(b"ab", k=30)) * 30
    starts = np.arange(len(data) - 100 + 1)
    number = repeats.refine(np.frombuffer(data, np.uint8), starts)
    by_text: dict = {}
    for s in starts.tolist():
        by_text.setdefault(data[s : s + 100], set()).add(int(number[s]))
    assert all(len(x) == 1 for x in by_text.values()) and len({min(x) for x in by_text.values()}) == len(by_text)


def test_groups_resolve_like_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        bases = [rng.integers(0, 300, 40) for _ in range(3)]
        sets = [np.unique(np.concatenate((b[: rng.integers(30, 41)], rng.integers(0, 300, rng.integers(0, 9))))).astype(np.uint64) for b in bases for _ in range(6)]
        root = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                c = len(np.intersect1d(sets[i], sets[j]))
                if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                    a, b = sorted((root[i], root[j]))
                    root = [a if r == b else r for r in root]
        assert neardup.resolve_group(sets).tolist() == root


def test_sketches():
    rng = np.random.default_rng(6)
    every = textops.mix(np.arange(1, 6001, dtype=np.uint64))
    a, b = np.sort(every[:4000]), np.sort(every[2000:])
    x, y = fingerprints.sketch(a), fingerprints.sketch(b)
    assert abs(fingerprints.resemblance(x, y) - 1 / 3) < 0.15
    assert abs(fingerprints.containment(x, y) - 0.5) < 0.2
    assert abs(fingerprints.distinct_count(x) / 4000 - 1) < 0.3
    cut = np.sort(rng.permutation(4000))[:1500]
    parts = [np.sort(a[cut]), np.sort(np.delete(a, cut))]
    assert (fingerprints.merge([fingerprints.sketch(p) for p in parts]) == x).all()
    assert (fingerprints.from_text(fingerprints.to_text(x)) == x).all()
    none = np.empty(0, np.uint64)
    assert fingerprints.resemblance(none, none) == 1 and fingerprints.resemblance(none, x) == 0


def test_patterns():
    text = "Mail a.b+c@x-y.example.com. @no a@b c@d.e@f.g IP 10.0.0.1 1.2.3.4.5.6.7.8 256.1.1.1 card 4111 1111 1111 1111; 4111-1111-1111-1112 tel +1 (228) 555-1624 +12 345"
    base = pii.base_spans(text)
    assert [text[s:e] for s, e in base["email"]] == [m[0] for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert [text[s:e] for s, e in base["ip"]] == ["10.0.0.1", "1.2.3.4", "5.6.7.8"]
    assert [text[s:e] for s, e in base["card"]] == ["4111 1111 1111 1111"]
    assert [text[s:e] for s, e in base["phone"]] == ["+1 (228) 555-1624"]
    long = "1" * 200_000 + "." + "a" * 200_000 + "@"
    assert not any(pii.base_spans(long).values())


@given(st.text(alphabet="a1.@-+ %é", max_size=40))
@settings(max_examples=300, deadline=None)
def test_patterns_like_plain_expressions(text):
    plain = {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15],
    }
    got = pii.base_spans(text)
    assert {k: got[k] for k in plain} == plain


def _some_model(rng):
    k = len(pii.LABELS)
    return pii.FieldModel(rng.normal(0, 1, (pii.N_SHAPE, k)), rng.normal(0, 1, (k, k)), rng.normal(1, 1, k), rng.normal(1, 1, k))


def _exact(field, model):
    """Marginals by the sum over all labellings, with the potentials written out one by one."""
    n, k = len(field.nodes), len(pii.LABELS)
    p = np.zeros((n, k))
    for labels in itertools.product(*[[x] if x else range(k) for x in field.label]):
        score = sum(float(field.shape[i] @ model.node[:, x]) for i, x in enumerate(labels))
        for a, b, kind in field.edges:
            if kind == pii.FORTH:
                score += model.chain[labels[a], labels[b]]
            elif labels[a] == labels[b]:
                score += (model.same if kind == pii.SAME else model.similar)[labels[a]]
        for i, x in enumerate(labels):
            p[i, x] += math.exp(score)
    return p / p.sum(1, keepdims=True)


def test_marginals_against_enumeration():
    rng = np.random.default_rng(3)
    trees = ["12 34 x 5555 y 77", "a@b.co 1234567 z 1234567 9", "+1 22 q (333) 4444444 r 9"]
    loops = ["1234567 1234567 x 1234567", "4444 5555 y 4444 5555", "+1 (222) 555-1212 5551212 5551212"]
    for _ in range(6):
        model = _some_model(rng)
        for text in trees:  # messages are exact there
            field = pii.Field(text, pii.base_spans(text))
            assert np.abs(field.marginals(model, 20) - _exact(field, model)).max() < 1e-9, text
    quiet = pii.FieldModel(model.node, model.chain * 0.1, model.same * 0.1, model.similar * 0.1)
    for text in loops:  # and near where the potentials are weak
        field = pii.Field(text, pii.base_spans(text))
        assert np.abs(field.marginals(quiet, 20) - _exact(field, quiet)).max() < 0.01


def _taught():
    """A model learnt from written texts, all kinds among them."""
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))

    def text():
        card = digits(15)
        card += next(str(c) for c in range(10) if pii.luhn(card + str(c)))
        some = [f"jo{digits(2)}.le@mail{digits(1)}.org", ".".join(str(rng.randrange(256)) for _ in range(4)), card, f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", digits(4), digits(16), "2024"]
        words = [rng.choice(["word", "other", "thing."]) for _ in range(40)]
        for x in rng.sample(some, 3):
            words.insert(rng.randrange(1, 40), x)
        return " ".join(words)

    import pyarrow as pa

    rows = next(pii._fit_rows([pa.RecordBatch.from_arrays([pa.array([text() for _ in range(600)])], ["text"])])).to_pandas()
    return pii.fit(rows.itertuples(index=False)), text


def test_skip_chain_adds_consistent_mentions():
    """Mentions in other forms are found where, and only where, the text also has the base span they belong to."""
    model, text = _taught()
    said = "Call +1 (228) 555-1624 now. Card 4111111111111111 ok. Later: 5551624? again 4111111111111111, mail bo.li@x.org or bo.li now 2024"
    base = pii.base_spans(said)
    added = [x for x in pii.all_spans(said, base, model) if (x[1], x[2]) not in base[x[0]]]
    assert [(k, said[s:e]) for k, s, e in added] == [("email", "bo.li"), ("phone", "5551624")]
    assert pii.all_spans("Later: 5551624? or bo.li in 2024", pii.base_spans("Later: 5551624? or bo.li in 2024"), model) == []
    planted = found = wrong = 0
    for i in range(150):
        t, true, _ = pii.plant(text(), random.Random(i), 1.0)
        base = pii.base_spans(t)
        spans = [x for x in pii.all_spans(t, base, model) if (x[1], x[2]) not in base[x[0]]]
        true = [(pii.LABELS[k], s, e) for s, e, k in true if not any(a < e and b > s for own in base.values() for a, b in own)]
        hits = [x for x in spans if any(k == x[0] and s < x[2] and e > x[1] for k, s, e in true)]
        planted, found, wrong = planted + len(true), found + len(hits), wrong + len(spans) - len(hits)
    assert found >= 0.9 * planted > 100 and wrong <= 0.1 * found
    assert pii.all_spans(said, pii.base_spans(said), pii.FieldModel.blank()) == sorted(((k, *x) for k, own in pii.base_spans(said).items() for x in own), key=lambda x: (pii.KINDS.index(x[0]), x[1]))
    assert pii.mask_text("x a@b.c y", [("email", 2, 7)]) == "x <EMAIL> y"


def test_many_mentions_stay_linear():
    text = "9876543 " * 3000 + "+1 (987) 654-3210"
    field = pii.Field(text, pii.base_spans(text))
    assert len(field.edges) <= 6 * len(field.nodes)


def test_mixtures():
    rng = random.Random(1)
    spell = {"aa": "abcde", "bb": "klmno", "cc": "vwxyz"}
    text = lambda x, n: " ".join("".join(rng.choices(spell[x], k=6)) for _ in range(n))
    counts = {}
    for lang in spell:
        g, _, _ = langid._grams([text(lang, 2000)])
        counts[lang] = np.bincount(g, minlength=1 << langid.BITS) + langid.SMOOTH
    model = langid.LanguageModel(tuple(spell), np.stack([np.log(c / c.sum()) for c in counts.values()], 1).astype(np.float32))
    names, scores, shares = langid.infer(model, [text("aa", 50), text("bb", 30) + " " + text("cc", 70), "", "12 34", text("cc", 1)])
    assert names == ["aa", "cc", "und", "und", "cc"]
    assert scores[0] == 1 and abs(scores[1] - 0.7) < 0.05 and abs(shares[1, 1] - 0.3) < 0.05 and shares[1, 0] == 0


def test_mixtures_by_plain_loops():
    """EM and the backward choice of languages, text by text and word by word, with Python floats."""
    rng, draw = random.Random(7), np.random.default_rng(7)
    model = langid.LanguageModel(("aa", "bb", "cc"), draw.normal(-8, 1.2, (1 << langid.BITS, 3)).astype(np.float32))
    texts = [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 25))) for _ in range(60)]

    def em(words, allowed):
        theta = [a / sum(allowed) for a in allowed]
        for _ in range(langid.EM_STEPS):
            total = [0.0] * 3
            for w in words:
                parts = [t * p for t, p in zip(theta, w, strict=True)]
                total = [x + p / sum(parts) for x, p in zip(total, parts, strict=True)]
            theta = [x / len(words) for x in total]
        return theta, sum(math.log(sum(t * p for t, p in zip(theta, w, strict=True))) for w in words)

    def plain(text):
        words = []
        for w in text.split():
            own = [sum(float(model.log_p[g, k]) for g in langid._grams([w])[0]) for k in range(3)]
            words.append([max(x - max(own), -langid.FLOOR) for x in own])
        if not words:
            return None
        single = [sum(w[k] for w in words) for k in range(3)]
        penalty = langid.PENALTY * math.log(len(words) + 1) / 2
        if -max(single) <= penalty:
            return [float(k == single.index(max(single))) for k in range(3)]
        words, allowed = [[math.exp(x) for x in w] for w in words], [1, 1, 1]
        theta, fit = em(words, allowed)
        for _ in range(2):
            least = min((t, k) for k, t in enumerate(theta) if allowed[k])[1]
            tried = [a if k != least else 0 for k, a in enumerate(allowed)]
            t, f = em(words, tried)
            if fit - f >= penalty:
                break
            allowed, theta, fit = tried, t, f
        return theta

    names, scores, shares = langid.infer(model, texts)
    mixed = 0
    for i, t in enumerate(texts):
        want = plain(t)
        if want is None:
            assert names[i] == "und" and scores[i] == 0
            continue
        assert shares[i] == pytest.approx(want, abs=1e-4) and scores[i] == pytest.approx(max(want), abs=1e-4)
        mixed += max(want) < 0.99
    assert mixed > 3


def test_noisy_or_learns_and_locates():
    rng = random.Random(2)
    bags, labels, texts = [], [], []
    for i in range(300):
        sentences = [" ".join(f"w{rng.randrange(60)}x".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(6)) for _ in range(5)]
        if i % 4 == 0:
            sentences[rng.randrange(5)] += " vile"
        texts.append(". ".join(sentences))
        labels.append(int(i % 4 == 0))
    for a in range(0, 300, 50):
        b, s, d, _ = toxicity._features([t.encode() for t in texts[a : a + 50]])
        bags.append((b, s, d))
    model = toxicity.fit(bags, np.array(labels))
    score = toxicity.score_texts(model, [t.encode() for t in texts])
    assert ((score >= 0.5) == np.array(labels)).mean() > 0.98
    assert 0 <= toxicity.score_texts(model, [b""])[0] < 0.5


def test_noisy_or_slopes_are_the_derivatives():
    """Against finite differences of the documents' log-likelihood, written out sentence by sentence."""
    rng = np.random.default_rng(5)
    doc = np.repeat(np.arange(40), rng.integers(1, 6, 40))
    z, y = rng.normal(-1, 1.5, len(doc)), rng.integers(0, 2, 40).astype(float)

    def loss(z):
        total = 0.0
        for d in range(40):
            none = math.prod(1 - 1 / (1 + math.exp(-x)) for x in z[doc == d].tolist())
            total -= math.log(1 - none) if y[d] else math.log(none)
        return total

    got = toxicity.slopes(z, 1 / (1 + np.exp(-z)), doc, y)
    for i in range(len(z)):
        up, down = z.copy(), z.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert got[i] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)


def test_scores_are_the_noisy_or_of_the_sentences():
    """A plain loop over sentences and words, with Python's own strings, gives the same scores."""
    rng = np.random.default_rng(6)
    model = toxicity.ToxicityModel(rng.normal(0, 1, 1 << toxicity.BITS).astype(np.float32), -1.0, 9)
    texts = ["", "One bad Word. And an okay one!", "no stop here", "x?\n\n... y", "Ünder-way again. again", "1 2 3. 4"]

    def buckets(word):
        parts = [word, *(word[:n] for n in toxicity.PREFIXES)]
        w = [textops.Words([p], ~toxicity.LETTER, b"\0") for p in parts]
        hashes = [w[0].hash[0], *(textops.mix(w[k].beginnings(n) + np.uint64(n))[0] for k, n in enumerate(toxicity.PREFIXES, 1))]
        return [int(h >> np.uint64(64 - toxicity.BITS)) for h in hashes]

    def plain(t):
        none, some = 1.0, False
        for sentence in re.split(rb"[.!?\n]", t.encode().lower()):
            words = re.findall(rb"[a-z\x80-\xff]+", sentence)
            if words:
                some = True
                none *= 1 - 1 / (1 + math.exp(-(model.bias + sum(float(model.weights[b]) for w in words for b in buckets(w)))))
        return 1 - none if some else 1 / (1 + math.exp(-model.bias))

    assert toxicity.score_texts(model, [t.encode() for t in texts]) == pytest.approx([plain(t) for t in texts], rel=1e-5)


def test_number_of_trees():
    """Pairs at the threshold meet with the wanted probability: paths are walked at random, as the trees would."""
    assert neardup.trees(0.9999) > neardup.trees(0.9)
    rng = random.Random(1)

    def meets(depth):
        if not depth:
            return True
        return any(rng.random() < 0.75 and meets(depth - 1) for _ in range(1 + (rng.random() < 1 / 3)))

    share = sum(any(meets(neardup.DEPTH) for _ in range(neardup.trees(0.9))) for _ in range(4000)) / 4000
    assert share > 0.88
