"""Personal data: fixed patterns, and a skip-chain conditional random field that makes mentions agree over a document.

The patterns give the base spans. Beside them a text mentions a number or address again in a form that no pattern takes (a
number without its plus sign or written with other separators, an address without its domain), or in a place where a
pattern fails (a number that runs on into the next one). The nodes of the field are the tokens that hold a digit or an @,
and the words that equal the local part of an address in the text. Adjacent nodes are linked in a chain; distant nodes of
equal or similar content share skip edges. The labels of the base spans are observed; loopy message passing gives every
other node its marginal, and a node where a label other than O has more than SURE of it becomes a span (adjacent nodes of
one label become one span).

All potentials (token shapes, label pairs along the chain, agreement over a skip edge) are learnt together, on a bounded,
documented sample of the texts. Base labels alone would teach the field that whatever no pattern takes is nothing, so
mentions in other forms are planted beside the base spans of the sample, as are numbers of the same forms that belong to
nothing. Texts in which a number runs on into the next one are left out of the sample, as their labels are not known.
The field is fitted as it is used: with the base labels observed, the gradient is what the sample shows of the
other labels less what the messages expect of them; pseudo-likelihood gives the first potentials.

Defined cases: null text is empty and has no spans; any length of text is taken whole in linear time; repeated rows get
equal spans; without any text to learn from the field adds nothing; spans count code points, end exclusive; other columns
pass through `mask`, and are not read by `find`.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
#: Possessive runs and the look-behind only save retries: a match that starts inside a run of digits never succeeds where its start failed.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

#: Documented bound: the field is fitted on the distinct texts with a digit or an @ that have the smallest hashes, so many at most.
FIT_DOCS = 2000
#: Documented bound: texts of more nodes are not fitted on (all texts are searched, however many nodes they have).
FIT_NODES = 200
ROUNDS = 8
LABELS = ("O", *KINDS)
#: Marginal from which a node becomes a span.
SURE = 0.5
#: Kinds of directed edges: along the chain, against it, equal content, similar content.
FORTH, BACK, SAME, SIMILAR = range(4)
ENDS = ".,;:!?()[]<>\"'"
NUMBER = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and not LOCAL_END.match(text[start - 1]):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            out.append((start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of the fixed patterns, by kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not DIGIT.search(text):
        return out
    out["email"] = _emails(text)
    out["ip"] = [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in _short(m[0]))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def _short(ip: str) -> list[str]:
    """The parts without leading zeros; a part too long to be at most 255 becomes 256."""
    return [p if len(p) <= 3 else "256" for p in (q.lstrip("0") or "0" for q in ip.split("."))]


def _content(token: str) -> tuple[list[str], list[str]]:
    """Keys by which tokens are equal, and keys by which they are similar."""
    core = token.strip(ENDS)
    digits = "".join(c for c in token if "0" <= c <= "9")
    if "@" in token:
        local = core.lower().split("@")[0]
        return [f"@{core.lower()}"], [f"@{local}"] if len(local) >= 4 else []
    similar = [f"@{core.lower()}"] if len(core) >= 4 else []
    parts = NUMBER.findall(core)
    if len(parts) == 4 and all(len(p) <= 3 for p in parts):
        similar.append("." + ".".join(parts))
    return ([f"#{core}"] if len(digits) >= 4 else []), similar


def _shape(token: str) -> tuple[float, ...]:
    core = token.strip(ENDS)
    digits = "".join(c for c in token if "0" <= c <= "9")
    n, parts = len(digits), core.split(".")
    return (
        1.0, float(n == 0 and "@" not in token), float("@" in token), float("@" in token and "." in token.split("@")[-1].strip(ENDS)),
        float(len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts)), float(token.startswith("+")), float("(" in token and n == 3),
        float(0 < n < 3), float(3 <= n < 7), float(7 <= n < 13), float(13 <= n <= 19), float(13 <= n <= 19 and luhn(digits)), float("-" in core and n >= 7),
        float("." in core and n >= 7), float(n > 0 and n == len(core)), float(n > 0 and 2 * n < len(core)),
        float(len(core) > 20 and "@" not in token),
    )


N_SHAPE = len(_shape("0"))


@dataclass(frozen=True)
class FieldModel:
    """Log-potentials: shapes x labels; label pairs along the chain; of each label, agreement over equal and over similar content."""

    node: np.ndarray
    chain: np.ndarray
    same: np.ndarray
    similar: np.ndarray

    @classmethod
    def blank(cls) -> FieldModel:
        """Adds nothing: every node is O."""
        k = len(LABELS)
        node = np.zeros((N_SHAPE, k))
        node[0, 0] = 20.0
        return cls(node, np.zeros((k, k)), np.zeros(k), np.zeros(k))

    def factors(self) -> np.ndarray:
        """exp of the potentials of each kind of directed edge, source label by target label."""
        agree = lambda w: np.exp(np.diag(w))
        return np.stack([np.exp(self.chain), np.exp(self.chain.T), agree(self.same), agree(self.similar)])


class Field:
    """The nodes and edges of one text. `planted` are further (start, end, label) known to the trainer."""

    def __init__(self, text: str, base: dict[str, list[tuple[int, int]]], planted: list[tuple[int, int, int]] = []):  # noqa: B006
        spans = sorted([*((s, e, k) for k, kind in enumerate(KINDS, 1) for s, e in base[kind]), *planted])
        tokens = [m.span() for m in TOKEN.finditer(text)]
        keys = [_content(text[s:e]) for s, e in tokens]
        # words that are the local part of an address, or equal to it but for signs around
        locals_ = {k[1:] for (s, e), (_, similar) in zip(tokens, keys, strict=True) if "@" in text[s:e] for k in similar}
        words = {w for w in locals_ if not DIGIT.search(w)}
        if words:
            there = set(tokens)
            for m in re.finditer(r"[^\x20\x09-\x0D]{4,}", text):
                if m.span() not in there and m[0].strip(ENDS).lower() in words:
                    tokens.append(m.span())
                    keys.append(_content(m[0]))
            order = sorted(range(len(tokens)), key=tokens.__getitem__)
            tokens, keys = [tokens[i] for i in order], [keys[i] for i in order]
        self.nodes = tokens
        self.label: list[int] = []
        i = 0
        for s, e in tokens:
            while i < len(spans) and spans[i][1] <= s:
                i += 1
            self.label.append(next((k for a, b, k in spans[i : i + 4] if a < e and b > s), 0))
        run = ""
        for n, (s, e) in enumerate(tokens):  # the last digits of adjacent tokens together, so that a number is like itself in any grouping
            run = "" if "@" in text[s:e] else ((run if n and self.adjacent(n) else "") + "".join(NUMBER.findall(text, s, e)))[-7:]
            if len(run) == 7:
                keys[n][1].insert(0, f"#{run}")
        self.edges: list[tuple[int, int, int]] = []
        last: dict[tuple[int, str], int] = {}
        known: dict[tuple[int, str], int] = {}
        for n, own in enumerate(keys):
            if n and self.adjacent(n):
                self.edges.append((n - 1, n, FORTH))
            linked = {-1}
            for kind, some in zip((SAME, SIMILAR), own, strict=True):
                for key in some:
                    # a link to the previous of the same content, and one to the first of it that a pattern takes
                    for other in sorted({last.get((kind, key), -1), known.get((kind, key), -1)} - linked):
                        linked.add(other)
                        self.edges.append((other, n, kind))
                    last[kind, key] = n
                    if self.label[n]:
                        known.setdefault((kind, key), n)
        self.shape = np.array([_shape(text[s:e]) for s, e in tokens]).reshape(-1, N_SHAPE)

    def adjacent(self, n: int) -> bool:
        """Whether node n follows node n - 1 with one separator between them."""
        return self.nodes[n][0] - self.nodes[n - 1][1] <= 1

    def marginals(self, model: FieldModel, rounds: int = ROUNDS, observed: bool = True) -> np.ndarray:
        """Node marginals by loopy sum-product; observed nodes keep their label."""
        label = np.array(self.label, np.int64) if observed else np.zeros(len(self.nodes), np.int64)
        return Messages(self.shape, label, np.array(self.edges, np.int64).reshape(-1, 3)).expect(model, rounds)[0]


class Messages:
    """Loopy sum-product on nodes of given shapes; those with an observed label keep it. edges: (node, node, kind) each."""

    def __init__(self, shape: np.ndarray, observed: np.ndarray, edges: np.ndarray):
        self.shape, self.observed, self.kind = shape, observed, edges[:, 2]
        a, b = edges[:, 0], edges[:, 1]
        self.source, self.target = np.concatenate((a, b)), np.concatenate((b, a))
        self.back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
        self.way = np.concatenate((self.kind, np.where(self.kind == FORTH, BACK, self.kind)))
        self.order = np.argsort(self.target, kind="stable")
        self.met, self.first = np.unique(self.target[self.order], return_index=True)
        self.of_way = [(w, i) for w in (FORTH, BACK, SAME, SIMILAR) if len(i := np.flatnonzero(self.way == w))]

    def expect(self, model: FieldModel, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
        """The marginals of nodes, and of each directed edge what its source says without what it hears over it."""
        local = self.shape @ model.node
        seen = np.flatnonzero(self.observed)
        local[seen] = -40.0
        local[seen, self.observed[seen]] = 40.0
        message = np.zeros((len(self.source), len(LABELS)))
        factors, belief = model.factors(), local
        for _ in range(rounds if len(self.source) else 0):
            out = belief[self.source] - message[self.back]
            p = np.exp(out - out.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            new = np.empty_like(p)
            for way, i in self.of_way:
                new[i] = p[i] @ factors[way]
            message = np.log(new / new.sum(1, keepdims=True) + 1e-30)
            belief = local.copy()
            belief[self.met] += np.add.reduceat(message[self.order], self.first)
        p = np.exp(belief - belief.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True), belief[self.source] - message[self.back]

    def pairs(self, model: FieldModel, said: np.ndarray) -> dict[int, np.ndarray]:
        """The expected number of edges of each kind and pair of labels."""
        side, m, factors = np.exp(said - said.max(1, keepdims=True)), len(self.kind), model.factors()
        out = {}
        for kind in (FORTH, SAME, SIMILAR):
            i = np.flatnonzero(self.kind == kind)
            pair = side[i, :, None] * factors[kind] * side[i + m, None, :]
            out[kind] = (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        return out

    def surroundings(self, label: np.ndarray) -> np.ndarray:
        """Of each node, how many neighbours of each label it has: before it and after it in the chain, of equal and of similar content."""
        out = np.zeros((len(self.shape), 4, len(LABELS)))
        np.add.at(out, (self.target, self.way, label[self.source]), 1)
        return out.reshape(len(self.shape), -1)


def _strip(text: str, s: int, e: int) -> tuple[int, int]:
    """Without signs at the ends; a bracket stays where its other half is inside."""
    ends = ENDS if text.count("(", s, e) != text.count(")", s, e) else ENDS.replace("()", "")
    while s < e and text[s] in ends:
        s += 1
    while e > s and text[e - 1] in ends:
        e -= 1
    return s, e


def all_spans(text: str, base: dict[str, list[tuple[int, int]]], model: FieldModel) -> list[tuple[str, int, int]]:
    """Base spans and those that the field adds, by kind and start."""
    found = [(kind, s, e) for kind in KINDS for s, e in base[kind]]
    if not DIGIT.search(text):
        return found  # no node
    field = Field(text, base)
    if 0 in field.label:
        p = field.marginals(model)
        best = p.argmax(1)
        sure = (p.max(1) > SURE) & (best > 0) & (np.array(field.label) == 0)
        run: list[int] = []  # label, start, end
        for n in np.flatnonzero(sure).tolist():
            s, e = field.nodes[n]
            if run and run[0] == best[n] and sure[n - 1] and field.adjacent(n):
                run[2] = e
                continue
            found += _span(text, run)
            run = [int(best[n]), s, e]
        found += _span(text, run)
    return sorted(found, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def _span(text: str, run: list[int]) -> list[tuple[str, int, int]]:
    if not run:
        return []
    s, e = _strip(text, run[1], run[2])
    return [(LABELS[run[0]], s, e)] if s < e else []


def other_form(kind: str, value: str, rng: random.Random) -> str:
    """A mention of a base span's value in a form that its pattern does not take."""
    digits = "".join(c for c in value if "0" <= c <= "9")
    if kind == "email":
        local, host = value.split("@")
        return rng.choice([local, f"{local}@{host.split('.')[0]}", f"<{local}>"])
    if kind == "ip":
        return rng.choice(["-", "_", ","]).join(value.split("."))
    if kind == "card":
        return rng.choice([digits[-8:], f"****{digits[-7:]}", ".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), "/".join(digits[i : i + 4] for i in range(0, len(digits), 4))])
    area, rest = digits[-10:-7], digits[-7:]
    return rng.choice([f"({area}) {rest[:3]}-{rest[3:]}" if area else rest, rest, f"{rest[:3]}-{rest[3:]}", digits, f"{area}.{rest[:3]}.{rest[3:]}"])


def _like(value: str, rng: random.Random) -> str:
    """Other digits and letters in the same form."""
    return "".join(rng.choice("0123456789") if "0" <= c <= "9" else rng.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in value)


def plant(text: str, rng: random.Random, share: float = 0.7) -> tuple[str, list[tuple[int, int, int]], list[tuple[int, int]]]:
    """The text with mentions of its base spans in other forms and with likenesses that belong to nothing; where both stand.

    Each is put before a word drawn at random, outside of the base spans.
    """
    base = base_spans(text)
    spans = sorted((s, e) for own in base.values() for s, e in own)
    free = [m.start() for m in re.finditer(r"(?<=[\x20\n])(?=[^\x20\x09-\x0D])", text) if all(m.start() <= s or m.start() > e + 1 for s, e in spans)]
    values = sorted({(k, text[s:e]) for k, kind in enumerate(KINDS, 1) for s, e in base[kind]})[:8]
    new: list[tuple[int, int, int, str]] = []
    for nth, (k, value) in enumerate(values):
        if free and rng.random() < share:
            if KINDS[k - 1] in ("phone", "card") and rng.random() < 0.3:  # as it is or another of its form, but it runs on into a number, so that the pattern fails
                place = rng.choice(free)
                follower = ".".join(str(rng.randrange(256)) for _ in range(4)) if KINDS[k - 1] == "phone" and rng.random() < 0.7 else _like("1" * rng.randint(8, 16), rng)
                own = value if rng.random() < 0.5 else _like(value, rng)
                if KINDS[k - 1] == "card":
                    own = next(c for c in (own[:-1] + d for d in "0123456789") if luhn(re.sub(r"[\x20-]", "", c)))
                new += [(place, 2 * nth, k, own), (place, 2 * nth + 1, 0, follower)]
                continue
            form = other_form(KINDS[k - 1], value, rng)
            new.append((rng.choice(free), 2 * nth, k, form))
            new.append((rng.choice(free), 2 * nth, 0, _like(form, rng)))
    out, at, planted, decoys, size = [], 0, [], [], 0
    for place, _, k, form in sorted(new):
        out += [text[at:place], form, " "]
        size += place - at
        if k:
            planted.append((size, size + len(form), k))
        else:
            decoys.append((size, size + len(form)))
        size, at = size + len(form) + 1, place
    return "".join([*out, text[at:]]), planted, decoys


def train(docs: DataFrame, fit_docs: int = FIT_DOCS) -> FieldModel:
    """All potentials from a bounded sample of the texts, with mentions planted in it."""
    common.prepare(docs.sparkSession)
    sample = common.smallest_distinct(docs.select(F.xxhash64("text").alias("h"), "text").where(F.col("text").rlike("[0-9@]")), "h", fit_docs).select("text")
    rows = sample.mapInArrow(_fit_rows, "label binary, observed binary, shape binary, edges binary").toPandas()  # fit_docs rows of at most FIT_NODES nodes
    return fit(rows.sort_values(list(rows.columns)).itertuples(index=False))


def fit(rows: Iterable[tuple[bytes, bytes, bytes, bytes]], steps: int = 600, message_steps: int = 200) -> FieldModel:
    """Potentials from the fields of `_fit_rows`: by pseudo-likelihood of each label given those around, then by what messages expect."""
    labels, observed, shapes, edges, n = [], [], [], [], 0
    for label, seen, shape, edge in rows:
        labels.append(np.frombuffer(label, np.int8).astype(np.int64))
        observed.append(np.frombuffer(seen, np.int8).astype(np.int64))
        shapes.append(np.frombuffer(shape, np.float32).reshape(-1, N_SHAPE).astype(float))
        edges.append(np.frombuffer(edge, np.int32).reshape(-1, 3).astype(np.int64) + [n, n, 0])
        n += len(labels[-1])
    if not n:
        return FieldModel.blank()
    label, field = np.concatenate(labels), Messages(np.concatenate(shapes), np.concatenate(observed), np.concatenate(edges))
    return _by_messages(_by_pseudo_likelihood(field, label, steps), field, label, message_steps)


def _ascend(w: list[np.ndarray], gradient: Callable[[list[np.ndarray]], Iterable[np.ndarray]], steps: int, shrink: float) -> list[np.ndarray]:
    """Gradient ascent with a step of its own for each potential, which shrinks as its gradients add up."""
    w, seen = [x.copy() for x in w], [np.full(x.shape, 1e-8) for x in w]
    for _ in range(steps):
        for x, d, total in zip(w, list(gradient(w)), seen, strict=True):
            d = d - shrink * x
            total += d * d
            x += 0.3 * d / np.sqrt(total)
    return w


def _by_pseudo_likelihood(field: Messages, label: np.ndarray, steps: int) -> FieldModel:
    k = len(LABELS)
    rows, weight = np.unique(np.concatenate((label[:, None], field.shape, np.minimum(field.surroundings(label), 3)), 1), axis=0, return_counts=True)
    shape, around = rows[:, 1 : 1 + N_SHAPE], rows[:, 1 + N_SHAPE :]
    y, n = np.eye(k)[rows[:, 0].astype(int)], weight[:, None] / weight.sum()
    before, after, same, similar = (around[:, i * k : (i + 1) * k] for i in range(4))

    def gradient(w: list[np.ndarray]) -> Iterator[np.ndarray]:
        z = shape @ w[0] + before @ w[1] + after @ w[1].T + same * w[2] + similar * w[3]
        p = np.exp(z - z.max(1, keepdims=True))
        g = n * (y - p / p.sum(1, keepdims=True))
        yield from (shape.T @ g, before.T @ g + (after.T @ g).T, (same * g).sum(0), (similar * g).sum(0))

    return FieldModel(*_ascend([np.zeros((N_SHAPE, k)), np.zeros((k, k)), np.zeros(k), np.zeros(k)], gradient, steps, 1e-5))


def _by_messages(start: FieldModel, field: Messages, label: np.ndarray, steps: int) -> FieldModel:
    """Ascent of the likelihood of the labels that are not observed, given those that are."""
    m, hidden = len(field.kind), max(1, int((field.observed == 0).sum()))
    y = np.eye(len(LABELS))[label]
    true = {kind: y[field.source[:m][field.kind == kind]].T @ y[field.target[:m][field.kind == kind]] for kind in (FORTH, SAME, SIMILAR)}

    def gradient(w: list[np.ndarray]) -> Iterator[np.ndarray]:
        model = FieldModel(*w)
        node, said = field.expect(model)
        more = {kind: (true[kind] - pair) / hidden for kind, pair in field.pairs(model, said).items()}
        yield field.shape.T @ (y - node) / hidden
        yield more[FORTH]
        yield from (np.diagonal(more[kind]) for kind in (SAME, SIMILAR))

    return FieldModel(*_ascend([start.node, start.chain, start.same, start.similar], gradient, steps, 1e-4))


def _runs_on(text: str) -> bool:
    """Whether a pattern took more digits than its kind has, so that what it took may hold a number of it."""
    count = lambda m: sum(map(str.isdigit, m[0]))
    return any(count(m) > 19 for m in CARD.finditer(text)) or "+" in text and any(count(m) > 15 for m in PHONE.finditer(text))


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The field of each text with mentions planted in it: true labels, those of base spans, shapes and edges."""
    names = ["label", "observed", "shape", "edges"]
    for batch in batches:
        rows = []
        for t in batch.column(0).to_pylist():
            if _runs_on(t or ""):
                continue
            text, planted, _ = plant(t or "", random.Random(zlib.crc32((t or "").encode("utf-8", "surrogatepass"))))
            base = base_spans(text)
            field = Field(text, base)
            if 0 < len(field.nodes) <= FIT_NODES:
                true = Field(text, base, planted).label
                rows.append((np.array(true, np.int8).tobytes(), np.array(field.label, np.int8).tobytes(), field.shape.astype(np.float32).tobytes(), np.array(field.edges, np.int32).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()) for c in zip(*rows, strict=True)] or [pa.array([], pa.binary())] * 4, names)


def find(docs: DataFrame, model: FieldModel) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans) of each row of docs (doc_id, text)."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                base = base_spans(t or "")
                spans = all_spans(t or "", base, model)
                listed = ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in base[k])
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(listed.encode()).hexdigest(), ",".join(f"{k}:{s}:{e}" for k, s, e in spans), len(spans) - sum(map(len, base.values())), len(spans)))
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            types = (pa.int64(),) * 4 + (pa.string(),) * 2 + (pa.int64(),) * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long")


def mask_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind's mark; of overlapping spans the first (then longer) gives the mark and all are covered."""
    out, done = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], MASKS[kind]]
        done = max(done, e)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, model: FieldModel) -> DataFrame:
    """docs with the personal data in text replaced; n_chars, where it exists as a number, follows. All columns stay."""
    common.prepare(docs.sparkSession)
    at, size = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [t and mask_text(t, all_spans(t, base_spans(t), model)) for t in texts]
            cols = list(batch.columns)
            cols[at] = pa.array(new, batch.schema.field(at).type)
            if size >= 0:
                old = batch.column(size).to_pylist()
                cols[size] = pa.array([o if a == b else len(b) for o, a, b in zip(old, texts, new, strict=True)], batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op2_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of every document, a row each; null and empty texts have none."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return find(docs, train(docs))
