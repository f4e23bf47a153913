"""Vectorised 64-bit hashing of the words of many texts at once (numpy).

Texts are joined as UTF-8 bytes; one pass of prefix sums gives every word's
rolling hash.  Memory is bounded by ``CHUNK_BYTES`` (a longer single text is a
chunk of its own), whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 2 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (shift-xor and odd multipliers)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random odd uint64 values, the same on every machine."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed)) | np.uint64(1)


_BYTE = seeded(256, 11)
_LANE = seeded(8, 12)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def spaces() -> np.ndarray:
    """Separator table: U+0020 and U+0009..U+000D."""
    t = np.zeros(256, bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as bytes) of chunks of bounded size; null is empty."""
    first, size, out = 0, 0, []
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if out and size + len(b) > limit:
            yield first, out
            first, size, out = i, 0, []
        out.append(b)
        size += len(b) + 1
    if out:
        yield first, out


def words(texts: list[bytes], separator: np.ndarray, fold: np.ndarray):
    """(hashes, start, end, bounds): the words of all texts in order; the words
    of text i are ``bounds[i]:bounds[i + 1]``; positions index the joined bytes."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sep = separator[raw]
    sep[-1] = True
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts_of = np.concatenate(([0], np.cumsum(lengths + 1)))
    sep[starts_of[1:] - 1] = True
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    if not sep[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    power, inverse = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[fold[raw]] * power[:len(raw)], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    return h, start, end, np.searchsorted(start, starts_of)


def shingles(h: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, counts per text), distinct and sorted per text: its runs of ``k``
    words, or the whole sequence as one where it has fewer words."""
    n = len(bounds) - 1
    out, sizes = [], np.zeros(n, np.int64)
    m = len(h) - k + 1
    g = np.zeros(max(m, 0), np.uint64)
    for j in range(k if m > 0 else 0):
        g += h[j:j + m] * _LANE[j]
    g = mix(g)
    for i in range(n):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= k:
            s = np.unique(g[a:b - k + 1])
        elif b > a:
            s = mix((h[a:b] * _LANE[:b - a]).sum(dtype=np.uint64, keepdims=True) + _LANE[7:] * np.uint64(b - a))
        else:
            continue
        sizes[i] = len(s)
        out.append(s)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def words_and_prefixes(texts: list[bytes], separator: np.ndarray, fold: np.ndarray,
                       prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owning text) of every word and of the beginnings of the words
    longer than them, of as many bytes as ``prefixes`` lists."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sep = separator[raw]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends_of = np.cumsum(lengths + 1)
    sep[ends_of - 1] = True
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    if not sep[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    power, inverse = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[fold[raw]] * power[:len(raw)], out=total[1:])
    owner = np.searchsorted(ends_of, start, "right")
    out, owners = [mix((total[end] - total[start]) * inverse[start])], [owner]
    for k in prefixes:
        at = np.flatnonzero(end - start > k)
        out.append(mix((total[start[at] + k] - total[start[at]]) * inverse[start[at]] + _LANE[k]))
        owners.append(owner[at])
    return np.concatenate(out), np.concatenate(owners)
