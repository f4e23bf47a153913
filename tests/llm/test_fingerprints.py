"""Fingerprints against plain Python and exact similarity."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_cases import rows
from pyspark.sql import functions as F

from hourcast.llm import fingerprints as fp
from hourcast.llm.bytehash import mix
from hourcast.llm.queries import QUERIES


def shingle_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_bins_and_densification():
    """Bins hold minima over the set; an empty bin walks its own order to the first full one."""
    texts = ["one two three four five six seven", "a b", "", "x " * 50 + "y", " ".join(f"w{i}" for i in range(3000))]
    v = fp.binned(texts)
    for t, row in zip(texts, v):
        seen = {}
        for s in shingle_set(t):
            one = fp.binned([" ".join(s)])[0]
            at = int(np.flatnonzero(one != fp._EMPTY)[0])
            seen[at] = min(seen.get(at, 1 << 64), int(one[at]))
        assert seen == {i: int(x) for i, x in enumerate(row) if x != fp._EMPTY}
    d = fp.densified(v.copy())
    for before, after in zip(v, d):
        full = [i for i, x in enumerate(before) if x != fp._EMPTY]
        for i, x in enumerate(after):
            walk = sorted(range(fp.BINS), key=lambda j: fp.PROBE[i, j])
            donor = i if i in full else next((j for j in walk if j in full), None)
            assert donor is None or x == before[donor]
    assert sorted(fp.PROBE[7]) == list(range(fp.BINS))


def test_packing_round_trip():
    text = " ".join(f"w{i}" for i in range(400))
    low = mix(fp.densified(fp.binned([text]))[0] + fp._PLACE) & np.uint64(15)
    packed = fp.prints([text])[0]
    bits = np.unpackbits(np.frombuffer(packed, np.uint8)).reshape(-1, fp.BITS)
    assert len(packed) == fp.BINS * fp.BITS // 8
    assert (bits @ [1, 2, 4, 8] == low).all()


def test_estimate_is_unbiased():
    """Mean error over pairs of known similarity is near 0; without correction it is not."""
    g = random.Random(4)
    error, raw = [], []
    for j in (0.0, 0.3, 0.6, 0.9):
        for _ in range(60):
            n = 600
            same = round(2 * n * j / (1 + j))
            base = [f"w{g.random()}" for _ in range(n)]
            # Two texts that share the first ``same`` words: shingles of those are shared.
            a, b = " ".join(base), " ".join(base[:same] + [f"v{g.random()}" for _ in range(n - same)])
            pa_, pb = fp.prints([a, b])
            got = fp.likeness([pa_], [pb])[0]
            error.append(got - jaccard(a, b))
            raw.append(got * 15 / 16 + 1 / 16 - jaccard(a, b))
    assert abs(np.mean(error)) < 0.01 < abs(np.mean(raw)) and np.std(error) < 0.04


def test_texts_of_one_shingle_are_told_apart():
    fps = fp.prints([f"word{i}" for i in range(200)])
    assert fp.likeness(fps[:-1], fps[1:]).max() < 0.1


def test_long_text_in_pieces():
    g = random.Random(5)
    text = "  ".join(str(g.randrange(10**6)) for _ in range(60_000)) + "\n" * 5000
    parts = fp.pieces(text.encode(), 10_000)
    assert len(parts) > 30
    assert set().union(*(shingle_set(p.decode()) for p in parts[:-1])) | (shingle_set(parts[-1].decode()) if len(parts[-1].split()) >= 5 else set()) == shingle_set(text)
    giant = b"x" * 50_000
    assert fp.pieces(giant, 1000) == [giant]
    # The same bins whatever the size of the pieces.
    whole = fp.binned([text])
    old = fp.pieces
    try:
        fp.pieces = lambda t: old(t, 10_000)
        assert (fp.binned([text]) == whole).all()
    finally:
        fp.pieces = old


def check(got, table, spark):
    hashed = spark.createDataFrame([(i, t or "") for i, t in table], "doc_id long, text string").withColumn("h", F.xxhash64("text")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    texts = [r.text for r in order]
    want = []
    for i, r in enumerate(order):
        nxt = texts[(i + 1) % len(texts)]
        q = len(r.text) // 4
        new = r.text[:len(r.text) - q] + nxt[:q]
        want.append((r.doc_id, len(r.text), hashlib.sha256(new.encode()).hexdigest(), fp.prints([r.text])[0].hex(),
                     fp.prints([new])[0].hex(), jaccard(r.text, new), jaccard(r.text, nxt)))
    have = sorted((tuple(r) for r in got), key=str)
    want.sort(key=str)
    assert [h[:3] for h in have] == [w[:3] for w in want]
    assert sorted(h[:5] for h in have if h[0] is not None) == sorted(w[:5] for w in want if w[0] is not None)
    for h, w in zip(have, want):
        assert h[5] == pytest.approx(w[5], abs=0.15) and h[6] == pytest.approx(w[6], abs=0.15)


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours_equal_brute_force(spark, messy, empty, parts):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = fp.compare_neighbours(messy).collect()
        check(got, [(r[0], r[1]) for r in rows()], spark)
        assert fp.compare_neighbours(empty).collect() == []
        lone = fp.compare_neighbours(messy.filter("doc_id = 9")).collect()
        check(lone, [(9, next(r[1] for r in rows() if r[0] == 9))], spark)
        # One id, and one text, hold most rows.
        hot = [(1, "same words over and over again")] * 60 + [(1, f"other text number {i}") for i in range(30)] + [(2, None)]
        df = spark.createDataFrame(hot, "doc_id long, text string").repartition(5)
        check(fp.compare_neighbours(df).collect(), hot, spark)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_fingerprint_keeps_columns(messy):
    out = fp.fingerprint(messy.withColumn("fingerprint", F.lit(1)))
    assert out.columns == [*messy.columns, "fingerprint"]
    by = {}
    for r in out.collect():
        by.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values()) and by[""] == {""}


def test_registered_query(spark):
    got = QUERIES["op12_document_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    table = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(got, table, spark)
