"""Document fingerprints: one-permutation MinHash with optimal densification.

Each word shingle (five words of the text with A-Z lower-cased) is hashed once.  The
high bits of the hash name one of ``BINS`` bins, the rest is its value, and a bin
keeps its smallest value.  An empty bin takes the value of the first bin that is not
empty in its own fixed random order of all bins, so that two texts that share a bin
share it in the same place.  The lowest ``BITS`` bits of each bin's value, hashed anew
with the bin's number (so that copies of one value in several bins agree with another
text's by chance only independently), are stored, packed.
``likeness`` estimates the Jaccard similarity of two shingle sets from the share m of
equal bins: ``(m - C) / (1 - C)``, where C = 2^-BITS is the chance of unequal values
having equal low bits.

``compare_neighbours`` holds every document against its edited text and against the
next document in order of ``doc_id``.  The texts are range-partitioned by id once; a
task walks its sorted rows with the next row at hand, and only the last row of each
partition meets the first row of the next one in a second, small step.  Equal rows are
spread over partitions by a row number.

Defined results: a null text is empty.  A text without words has the empty
fingerprint; two of them have likeness 1, one and any other 0.  A text of fewer than
five words has one shingle, its whole sequence.  Null ids come first; rows of equal id
are ordered by a hash of their texts, equal rows follow each other.  Long texts are
hashed in overlapping pieces, whole.  A lone document is its own next.  An empty table
gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import CHUNK_BYTES, chunks, lower_table, mix, seeded, spaces, words
from .common import materialise

SHINGLE = 5
BINS = 256
BITS = 4
PIECE_BYTES = 1 << 20
_EMPTY = np.uint64((1 << 64) - 1)
_LANE = seeded(SHINGLE, 31)
_SHORT = seeded(SHINGLE, 32)
_PLACE = seeded(BINS, 34)
# PROBE[i, j]: place of bin j in the order in which bin i, when empty, tries the others.
PROBE = mix(np.arange(BINS * BINS, dtype=np.uint64) + seeded(1, 33)).reshape(BINS, BINS).argsort(1).argsort(1).astype(np.uint16)


def pieces(text: bytes, limit: int = PIECE_BYTES) -> list[bytes]:
    """The text in pieces of about ``limit`` bytes, cut at white space; each begins with
    the last words of the one before, so that every run of SHINGLE words is in a piece."""
    if len(text) <= limit or len(text.split(None, SHINGLE)) < SHINGLE:
        return [text]
    space = spaces()
    raw = np.frombuffer(text, np.uint8)
    out, carry, at = [], b"", 0
    while at < len(text):
        end = at + limit
        while end < len(text):
            gap = np.flatnonzero(space[raw[end:end + limit]])
            if len(gap):
                end += int(gap[0])
                break
            end += limit
        out.append(carry + b" " + text[at:end])
        carry = b" ".join(out[-1].rsplit(None, SHINGLE - 1)[-(SHINGLE - 1):])
        at = min(end, len(text))
    return out


def binned(texts: list, bins: int = BINS) -> np.ndarray:
    """Smallest value in each bin, a row for each text; ``_EMPTY`` marks an empty bin."""
    out = np.full((len(texts), bins), _EMPTY)
    flat, sep, fold = out.reshape(-1), spaces(), lower_table()
    shift = np.uint64(64 - (bins - 1).bit_length())
    for first, group in chunks(texts):
        parts = [(first + i, p, n) for i, t in enumerate(group) for ps in [pieces(t)] for n in [len(ps)] for p in ps]
        while parts:
            take, size = 0, 0
            while take < len(parts) and (not take or size + len(parts[take][1]) <= CHUNK_BYTES):
                size += len(parts[take][1])
                take += 1
            now, parts = parts[:take], parts[take:]
            h, _, _, bounds = words([p for _, p, _ in now], sep, fold)
            count = np.diff(bounds)
            m = len(h) - SHINGLE + 1
            g = np.zeros(max(m, 0), np.uint64)
            for j in range(SHINGLE if m > 0 else 0):
                g += h[j:j + m] * _LANE[j]
            runs = np.maximum(count - SHINGLE + 1, 0)
            owner = np.repeat([i for i, _, _ in now], runs)
            place = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(bounds[:-1], runs)
            value = mix(g[place]) if len(place) else np.zeros(0, np.uint64)
            short = [k for k in np.flatnonzero((count > 0) & (count < SHINGLE)) if now[k][2] == 1]
            if short:
                extra = np.array([(h[bounds[k]:bounds[k + 1]] * _LANE[:count[k]]).sum(dtype=np.uint64) for k in short], np.uint64)
                value = np.concatenate((value, mix(extra + _SHORT[count[short]])))
                owner = np.concatenate((owner, [now[k][0] for k in short]))
            low = value & ((np.uint64(1) << shift) - np.uint64(1))
            np.minimum.at(flat, owner.astype(np.int64) * bins + (value >> shift).astype(np.int64), low)
    return out


def densified(values: np.ndarray) -> np.ndarray:
    """Empty bins filled in place, in rows that have a bin that is not empty."""
    gaps = values == _EMPTY
    some = gaps.any(1) & ~gaps.all(1)
    for r in np.flatnonzero(some):
        empty, full = np.flatnonzero(gaps[r]), np.flatnonzero(~gaps[r])
        values[r, empty] = values[r, full[PROBE[np.ix_(empty, full)].argmin(1)]]
    return values


def prints(texts: list, bits: int = BITS) -> list[bytes]:
    """Packed low-order bits of each text's bins; empty for a text without words."""
    v = densified(binned(texts))
    low = mix(v + _PLACE)
    packed = np.packbits(((low[:, :, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).reshape(len(v), -1), axis=1)
    none = (v == _EMPTY).all(1)
    return [b"" if e else p.tobytes() for e, p in zip(none, packed)]


def likeness(a: list[bytes], b: list[bytes], bits: int = BITS) -> np.ndarray:
    """Estimated similarity of fingerprints, pair by pair."""
    out = np.array([float(not x and not y) for x, y in zip(a, b)])
    both = [i for i, (x, y) in enumerate(zip(a, b)) if x and y]
    if both:
        x, y = (np.frombuffer(b"".join(s[i] for i in both), np.uint8).reshape(len(both), -1) for s in (a, b))
        unequal = np.unpackbits(x ^ y, axis=1).reshape(len(both), -1, bits).any(2)
        chance = 2.0**-bits
        out[both] = np.clip((1 - unequal.mean(1) - chance) / (1 - chance), 0, 1)
    return out


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``fingerprint`` (hex), in place of one of that name."""
    keep = [c for c in docs.columns if c != "fingerprint"]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("fingerprint", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = prints(batch.column(keep.index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=[*keep, "fingerprint"])

    out = docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
    return out.withColumn("fingerprint", F.lower(F.hex("fingerprint")))


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the next one."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_STEP = _RESULT + ", part int, role string, h long, mid long, text string"


def _compared(ids: list, texts: list[str], own: list[bytes], following: list[str], following_prints: list[bytes]) -> list[pa.Array]:
    """Arrays of _RESULT for texts whose next ones are given."""
    new = [edited(t, f) for t, f in zip(texts, following)]
    changed = prints(new)
    sha = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new]
    return [pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array(sha, pa.string()), pa.array(own, pa.binary()),
            pa.array(changed, pa.binary()), pa.array(likeness(own, changed), pa.float64()), pa.array(likeness(own, following_prints), pa.float64())]


def _slices(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """Rows of the batch in lists of about CHUNK_BYTES of text."""
    rows, size = [], 0
    for row in zip(*(batch.column(i).to_pylist() for i in range(2)), *(batch.column(i).to_pylist() for i in (2, 3))):
        rows.append(row)
        size += len(row[1])
        if size > CHUNK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (doc_id, text, h, mid) of a partition: all but the last are compared
    with their next; the first and the last also come out with their text."""
    part = TaskContext.get().partitionId()
    names = [c.split()[0] for c in _STEP.split(", ")]

    def mark(row: tuple, fp: bytes, role: str) -> pa.RecordBatch:
        none = [pa.nulls(1, t) for t in (pa.string(), pa.binary(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([
            pa.array([row[0]], pa.int64()), pa.array([len(row[1])], pa.int64()), none[0], pa.array([fp], pa.binary()), *none[1:],
            pa.array([part], pa.int32()), pa.array([role]), pa.array([row[2]], pa.int64()), pa.array([row[3]], pa.int64()),
            pa.array([row[1]], pa.string())], names=names)

    last = None
    for batch in batches:
        for rows in _slices(batch):
            fps = prints([r[1] for r in rows])
            if last is None:
                yield mark(rows[0], fps[0], "first")
            else:
                rows, fps = [last[0], *rows], [last[1], *fps]
            last = (rows[-1], fps[-1])
            if len(rows) > 1:
                texts = [r[1] for r in rows]
                out = _compared([r[0] for r in rows[:-1]], texts[:-1], fps[:-1], texts[1:], fps[1:])
                n = len(rows) - 1
                yield pa.RecordBatch.from_arrays([*out, pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()),
                                                  pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], names=names)
    if last is not None:
        yield mark(*last, "last")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RESULT.split(", ")]
    for batch in batches:
        yield pa.RecordBatch.from_arrays(_compared(*(batch.column(i).to_pylist() for i in range(5))), names=names)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex),
    near_edited, near_next for each row of (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    key = ["doc_id", "h", "mid"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"),
                       F.monotonically_increasing_id().alias("mid"))
    step = materialise(rows.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_walk, _STEP), "fingerprints")
    first = step.filter("role = 'first'")
    # One row per partition of the table, ids alone.
    order = Window.orderBy(*key)
    link = first.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next_part"))
    last = step.filter("role = 'last'").select("part", "doc_id", "text", "fingerprint")
    head = first.select(F.col("part").alias("next_part"), F.col("text").alias("following"), F.col("fingerprint").alias("following_print"))
    pairs = last.join(link, "part").join(head, "next_part").select("doc_id", "text", "fingerprint", "following", "following_print")
    names = [c.split()[0] for c in _RESULT.split(", ")]
    out = step.filter("role is null").select(*names).unionByName(pairs.mapInArrow(_finish, _RESULT))
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
