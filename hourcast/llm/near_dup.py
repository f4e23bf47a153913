"""MinHash near-duplicates with sequential Bayesian verification.

1. Texts become sets of hashed word shingles; texts with equal sets form a
   class (grouped by a 128-bit digest), and one numbered representative goes on.
2. ``BANDS`` bands of ``ROWS`` MinHash values give buckets of candidates.
3. Star phase: each bucket compares its members with its smallest member.
   Candidates are compared batch by batch of their signatures; after each batch
   a pair is pruned when the posterior probability (uniform prior) that its
   similarity reaches the threshold is below ``MISS``.  Survivors are verified
   exactly on full sets.
4. Verified links are contracted to components.  A bucket whose members are all
   in one component is done.  In the others, every pair of different components
   is still compared: small buckets by a join (a bounded number of pairs for
   each row), large ones in square blocks of bounded size, where pairs are
   pruned, verified and contracted inside the task, and only links that join
   components leave it.  So no candidate pair goes untested, and no large bucket
   is expanded into all its pairs of rows.
5. Components by alternating stars over the links; the label is the smallest id.

A pair at the threshold is missed with probability ``(1 - t^ROWS)^BANDS`` (5e-8
at 0.8) for lack of a common bucket, and below ``MISS`` for each batch.

Defined results: a null or empty text has no shingles and is linked with
nothing.  A null ``doc_id`` gets a null component and is kept.  Rows of equal
``doc_id`` are one document if their texts are equal; all its rows are kept alike
in ``near_duplicates``, and one of them stays in ``distinct_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import chunks, lower_table, mix, seeded, shingles, spaces, words
from .common import materialise

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BATCH = 16
MISS = 1e-6
SMALL_BUCKET = 16
BLOCK_DOCS = 1024
BLOCK_SHINGLES = 1 << 20
BROADCAST_IDS = 1 << 20

_A, _B = seeded(HASHES, 21), seeded(HASHES, 22)


def shingle_sets(texts: list, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, values, counts per text) of chunks of bounded size."""
    sep, fold = spaces(), lower_table()
    for first, part in chunks(texts):
        h, _, _, bounds = words(part, sep, fold)
        values, sizes = shingles(h, bounds, k)
        yield first, values, sizes


def signatures(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """uint32 MinHash values, a row for each text with a shingle."""
    some = sizes[sizes > 0]
    starts = np.concatenate(([0], np.cumsum(some)[:-1])).astype(np.int64)
    out = np.empty((len(some), HASHES), np.uint32)
    for j in range(HASHES if len(some) else 0):
        h = ((values * _A[j] + _B[j]) >> np.uint64(32)).astype(np.uint32)
        out[:, j] = np.minimum.reduceat(h, starts)
    return out


def digests(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each set that is not empty."""
    some = sizes[sizes > 0]
    starts = np.concatenate(([0], np.cumsum(some)[:-1])).astype(np.int64)
    return [np.add.reduceat(mix(values ^ s), starts) if len(some) else np.zeros(0, np.uint64) for s in seeded(2, 23)]


def signed(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, row, n, d1, d2, sig, bands): set size and digest, low bytes of the
    signature, band hashes; the last four null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, values, sizes in shingle_sets(batch.column(1).to_pylist(), k):
                at = np.flatnonzero(sizes)
                sig = signatures(values, sizes)
                d = digests(values, sizes)
                lanes = seeded(HASHES, 24).reshape(BANDS, ROWS)
                band = mix((sig.astype(np.uint64).reshape(-1, BANDS, ROWS) * lanes).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                low = sig.astype(np.uint8)
                n = len(sizes)
                where = {int(i): r for r, i in enumerate(at)}
                pick = [where.get(i) for i in range(n)]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, n), batch.column(2).slice(first, n), pa.array(sizes, pa.int64()),
                    *[pa.array([None if r is None else int(x[r]) for r in pick], pa.int64()) for x in (y.view(np.int64) for y in d)],
                    pa.array([None if r is None else low[r].tobytes() for r in pick], pa.binary()),
                    pa.array([None if r is None else band[r].view(np.int64) for r in pick], pa.list_(pa.int64())),
                ], names=["doc_id", "row", "n", "d1", "d2", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "row").mapInArrow(
        run, "doc_id long, row long, n long, d1 long, d2 long, sig binary, bands array<long>")


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """(d1, d2, n, set) of the sets that are not empty: digest, size and the sorted
    shingle hashes as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, values, sizes in shingle_sets(batch.column(0).to_pylist(), k):
                d1, d2 = (pa.array(x.view(np.int64)) for x in digests(values, sizes))
                some = sizes[sizes > 0]
                out = [values[e - s:e].tobytes() for s, e in zip(some, np.cumsum(some))]
                yield pa.RecordBatch.from_arrays([d1, d2, pa.array(some, pa.int64()), pa.array(out, pa.binary())], names=["d1", "d2", "n", "set"])

    return docs.select("text").mapInArrow(run, "d1 long, d2 long, n long, set binary")


@lru_cache
def least_matches(percent: int = PERCENT, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(compared, least matches to go on) after each batch: the smallest m with
    P(similarity >= t | m of n match) >= miss, which under a uniform prior is
    P(Binomial(n + 1, t) <= m)."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                out.append((n, m))
                break
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Indexes of the rows of signature bytes that no batch prunes."""
    live = np.arange(len(a))
    seen, matches = 0, np.zeros(len(a), np.int64)
    for n, least in least_matches(percent):
        matches = matches + (a[live, seen:n] == b[live, seen:n]).sum(1)
        keep = matches >= least
        live, matches, seen = live[keep], matches[keep], n
    return live


def unpruned(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sequential comparison of their signatures leaves."""
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, HASHES) for n in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).take(pa.array(survivors(a, b, percent)))

    near = pairs.join(left, "a").join(right, "b").filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return near.select("a", "b", "sig_a", "sig_b").mapInArrow(prune, "a long, b long")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = common(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
    full = full.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b")
    return full.select("a", "b", "set_a", "set_b").mapInArrow(exact, "a long, b long")


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Values in both sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0


def components(edges: DataFrame, tag: str = "near-star") -> DataFrame:
    """(node, root): the smallest node of each component, for the nodes of
    ``edges`` (a, b) that are not roots; alternating large and small stars."""
    spark = edges.sparkSession
    e = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), tag)
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), tag)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links between components in large buckets: members (bucket, nb, rep, comp,
    pivot, sig, bands, set), each bucket cut into ``nb`` blocks and each pair of
    blocks compared in one task.  A pair is compared in the first band it
    shares.  Only links that join two components of the block leave."""
    block = F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")
    m = members.withColumn("bk", block)
    other = F.explode(F.sequence(F.lit(0), (F.col("nb") - 1).cast("int")))
    m = m.withColumn("o", other).withColumn("x", F.least("bk", "o")).withColumn("y", F.greatest("bk", "o"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        links = links_in_block(group, percent, int(key[1]), int(key[2]))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    cols = ["band", "bucket", "x", "y", "bk", "rep", "comp", "n", "sig", "bands", "set"]
    return m.select(*cols).groupBy("bucket", "x", "y").applyInPandas(run, "a long, b long")


def links_in_block(group: pd.DataFrame, percent: int, x: int, y: int) -> list[tuple[int, int]]:
    comp = group["comp"].to_numpy()
    if (comp == comp[0]).all():
        return []
    rep, n, bk, band = (group[c].to_numpy() for c in ("rep", "n", "bk", "band"))
    sig = np.frombuffer(b"".join(group["sig"]), np.uint8).reshape(-1, HASHES)
    bands = np.array([np.asarray(v) for v in group["bands"]])[:, :int(band[0])]
    sets = [np.frombuffer(s, np.uint64) for s in group["set"]]
    parent: dict[int, int] = {int(c): int(c) for c in np.unique(comp)}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links = []
    cat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(cat, kind="stable")
    cat, owner = cat[order], owner[order]
    now = comp.copy()
    right = np.flatnonzero(bk == y)
    for i in np.flatnonzero(bk == x):
        js = right if x != y else right[right > i]
        js = js[now[js] != now[i]]
        js = js[100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i])]
        if len(js):
            js = js[~(bands[js] == bands[i]).any(1)]
        if len(js):
            js = js[survivors(np.broadcast_to(sig[i], (len(js), HASHES)), sig[js], percent)]
        if not len(js):
            continue
        if len(js) > 8:  # intersections with all of the block at once
            lo, hi = np.searchsorted(cat, sets[i], "left"), np.searchsorted(cat, sets[i], "right")
            size = hi - lo
            flat = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            both = np.bincount(owner[flat], minlength=len(sets))[js]
        else:
            both = np.array([common(sets[i], sets[j]) for j in js])
        for j in js[100 * both >= percent * (n[js] + n[i] - both)]:
            p, q = root(int(comp[i])), root(int(comp[j]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                links.append((int(rep[i]), int(rep[j])))
                now = np.where(now == max(p, q), min(p, q), now)
    return links


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (smallest
    doc_id reachable over links of similarity >= ``percent``) and ``kept``."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("long").alias("row"))
    out = grouped(src, k, percent)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def grouped(src: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, row, n, comp, component_id) of every row of ``src`` (doc_id, text,
    row): ``comp`` numbers the component, null for a row that is linked with nothing."""
    all_docs = materialise(signed(src, k), "near-signed")
    known = all_docs.filter("n > 0 and doc_id is not null")
    classes = known.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("first"))
    classes = materialise(classes.withColumn("rep", F.monotonically_increasing_id()), "near-classes")
    keyed = known.join(classes, ["d1", "d2", "n"])
    reps = materialise(keyed.filter("doc_id = first").select("rep", "n", "sig", "bands").dropDuplicates(["rep"]), "near-reps")
    members = reps.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    buckets = members.groupBy("bucket").agg(F.count("*").alias("cnt"), F.min("rep").alias("pivot"), F.sum("n").alias("weight"))
    members = members.join(buckets.filter("cnt > 1"), "bucket")
    members = materialise(members.select("band", "bucket", "rep", "n", "cnt", "pivot", "weight"), "near-members")
    pivots = members.filter("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    few = members.filter((F.col("cnt") > 2) & (F.col("cnt") <= SMALL_BUCKET)).filter("rep != pivot")
    inner = few.select("bucket", F.col("rep").alias("a")).join(few.select("bucket", F.col("rep").alias("b")), "bucket")
    stars = materialise(unpruned(pivots, reps, percent), "near-stars")
    inner = materialise(unpruned(inner.filter("a < b").select("a", "b").distinct(), reps, percent), "near-pairs")
    many = members.filter(F.col("cnt") > SMALL_BUCKET)
    ids = stars.union(inner).select(F.explode(F.array("a", "b")).alias("rep")).union(many.select("rep")).distinct()
    wanted = materialise(classes.join(ids, "rep", "left_semi"), "near-ids")
    ids = wanted.select(F.col("first").alias("doc_id")).distinct()
    # Few enough ids go to the texts; more than that, and each text moves once to its id.
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = sets_of(src.join(ids, "doc_id", "left_semi"), k).dropDuplicates(["d1", "d2", "n"])
    sets = materialise(sets.join(wanted, ["d1", "d2", "n"]).select("rep", "set"), "near-sets")
    links = materialise(linked(stars, sets, percent), "near-links")
    roots = components(links)

    def with_comp(df: DataFrame, node: str = "rep", comp: str = "comp") -> DataFrame:
        r = roots.select(F.col("node").alias(node), "root")
        return df.join(r, node, "left").withColumn(comp, F.coalesce("root", node)).drop("root")

    pairs = with_comp(with_comp(inner, "a", "ca"), "b", "cb").filter("ca != cb").select("a", "b")
    links = links.union(materialise(linked(pairs, sets, percent), "near-links"))
    roots = components(links)
    many = with_comp(many)
    mixed = many.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi")
    nb = F.greatest(F.ceil(F.col("cnt") / BLOCK_DOCS), F.ceil(F.col("weight") / BLOCK_SHINGLES))
    many = many.join(mixed.select("bucket"), "bucket").withColumn("nb", nb).join(reps.select("rep", "sig", "bands"), "rep")
    many = many.join(sets, "rep")
    links = links.union(materialise(block_links(many, percent), "near-links"))
    roots = components(links)
    # The smallest doc_id of the components of several classes.
    nodes = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    nodes = materialise(nodes.join(classes.select(F.col("rep").alias("node"), "first"), "node"), "near-nodes")
    labels = materialise(nodes.groupBy("root").agg(F.min("first").alias("label")), "near-labels")
    labels = F.broadcast(labels) if labels.count() <= BROADCAST_IDS else labels
    nodes = nodes.join(labels, "root").select(F.col("node").alias("rep"), F.col("root").alias("comp"), "label")
    final = classes.join(nodes, "rep", "left").select(
        "d1", "d2", "n", F.coalesce("comp", "rep").alias("comp"), F.coalesce("label", "first").alias("label"))
    out = all_docs.filter("n > 0").select("doc_id", "row", "n", "d1", "d2").join(final, ["d1", "d2", "n"], "left")
    has = F.col("doc_id").isNotNull()
    out = out.select("doc_id", "row", "n", F.when(has, F.col("comp")).alias("comp"), F.when(has, F.col("label")).alias("component_id"))
    none = all_docs.filter("n = 0").select("doc_id", "row", "n", F.lit(None).cast("long").alias("comp"), F.col("doc_id").alias("component_id"))
    return out.union(none)


def distinct_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """The documents that stay, one row of each group, columns unchanged: the first
    written of its smallest ``doc_id``.  Rows that are linked with nothing stay."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    col = dict(zip(docs.columns, names))
    d = materialise(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "near-rows")
    src = d.select(F.col(col[doc_id]).cast("long").alias("doc_id"), F.col(col[text]).alias("text"), "row")
    rows = materialise(grouped(src, k, percent).filter("comp is not null").select("comp", "doc_id", "row"), "near-groups")
    stay = rows.groupBy("comp").agg(F.min(F.struct("doc_id", "row"))["row"].alias("row"))
    lost = rows.select("row").join(stay, "row", "left_anti")
    return d.join(lost, "row", "left_anti").select(*names).toDF(*docs.columns)
