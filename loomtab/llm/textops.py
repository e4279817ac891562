"""Array arithmetic over the bytes of many texts at once: words, word hashes, shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Fixed odd multipliers of the polynomial and mixing hashes.
BASE = 0x9E3779B97F4A7C15 | 1
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
STEP = 0xD6E8FEB86659FD93
WORD = 2**64

#: Texts are handled together up to about so many bytes; one longer text is a group of its own.
GROUP_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of a well-known splittable generator)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(MIX_A)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(MIX_B)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n; tables are kept and grown."""
    if not _powers or len(_powers["up"]) < n:
        m = max(n, GROUP_BYTES + 1024)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, WORD))):
            out = np.empty(m, np.uint64)
            out[0] = 1
            done = 1
            while done < m:
                k = min(done, m - done)
                out[done : done + k] = out[:k] * np.uint64(pow(base, done, WORD))
                done += k
            _powers[name] = out
    return _powers["up"][:n], _powers["down"][:n]


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` values (bytes, code points) from each place on."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(values) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], dtype=np.uint64)))
    return mix((total[size:] - total[:n]) * down[:n])


def groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about GROUP_BYTES together."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > GROUP_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words of some texts: start and end byte, number of the text, and a 64-bit hash."""

    def __init__(self, texts: list[bytes], separator: np.ndarray = SPACE, joint: bytes = b" "):
        buf = joint.join([*texts, b""]) if texts else b""
        self.bytes = np.frombuffer(buf, np.uint8)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
        inside = np.concatenate(([False], ~separator[self.bytes], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        self.text = np.searchsorted(self.text_start, self.start, "right") - 1
        up, down = powers(len(buf) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], dtype=np.uint64)))
        self._total, self._down = total, down
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])

    def beginnings(self, n: int) -> np.ndarray:
        """Hashes of the first n bytes of each word (of all of a shorter one)."""
        return (self._total[np.minimum(self.start + n, self.end)] - self._total[self.start]) * self._down[self.start]


def shingles(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """For each text, the sorted distinct hashes of its shingles of `size` whitespace-separated words, A-Z lower-cased.

    A text of fewer words has its whole word sequence as one shingle; one without words has none.
    """
    out: list[np.ndarray] = []
    for a, b in groups(texts):
        w = Words([t.lower() for t in texts[a:b]])
        first = np.searchsorted(w.text, np.arange(b - a + 1))
        h = np.zeros(max(0, len(w.hash) - size + 1), np.uint64)
        for j in range(size):
            h = h * np.uint64(STEP) + w.hash[j : j + len(h)]
        h = mix(h)
        for i in range(b - a):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= size:
                out.append(np.unique(h[lo : hi - size + 1]))
            elif hi > lo:
                s = int(hi - lo)
                for x in w.hash[lo:hi].tolist():
                    s = (s * STEP + x) % WORD
                out.append(mix(np.array([s], np.uint64)))
            else:
                out.append(np.empty(0, np.uint64))
    return out
