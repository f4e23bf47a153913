"""Manifest and multiproofs against a plain recursive tree."""

import hashlib
import zlib

import numpy as np
import pytest
from llm_cases import SCHEMA, rows
from pyspark.sql import functions as F

from hourcast.llm import merkle
from hourcast.llm.queries import QUERIES


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def tree(nodes):
    """(root, list of levels)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([h("".join(n[i:i + 8])) for i in range(0, len(n), 8)])
    return levels[-1][0], levels


def walk(levels, pos, leaf):
    """(siblings, root folded from leaf)."""
    out = []
    for nodes in levels[:-1]:
        run = nodes[pos // 8 * 8:pos // 8 * 8 + 8]
        i = pos % 8
        out += run[:i] + run[i + 1:]
        leaf = h("".join(run[:i] + [leaf] + run[i + 1:]))
        pos //= 8
    return out, leaf


def brute(table):
    """Result rows for (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in table:
        leaf = h("".join(map(field, (i, source, lang, n, text))))
        bad = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        claim = h("".join(map(field, (i, source, lang, n, lower(text) if bad else text))))
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf, claim, i))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: r[:3])
        trees[g] = tree([r[2] for r in groups[g]])
    if not order:
        return []
    root, tops = tree([trees[g][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for pos, (_, _, leaf, claim, i) in enumerate(groups[g]):
            proof, sub = walk(trees[g][1], pos, claim)
            more, folded = walk(tops, at, sub)
            out.append((i, leaf, trees[g][0], root, h("".join(proof + more)), folded, folded == root))
    return sorted(out, key=str)


def result(df):
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    out = merkle.prove(merkle.manifest(merkle.document_leaves(df, tampered)), "claimed")
    return sorted((tuple(r) for r in out.collect()), key=str)


def case(spark, table):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in table], SCHEMA).repartition(6)


TABLES = {
    "many": [(i * 7 % 1000, f"Text {i} É", "en" if i % 10 else "de", "s", i) for i in range(1000)]
    + [(i, f"own {i}", f"l{i}", None, None) for i in range(70)],
    "run": [(i, f"T{i}", None, "s", i) for i in range(9)],
    "lone": [(5, "A", "en", "s", 1)],
    "equal": [(None, None, None, None, None)] * 20 + [(3, "Same", "x", "s", 1)] * 40 + [(3, "same", "x", "s", 1)] * 9,
}


@pytest.mark.parametrize("name", TABLES)
@pytest.mark.parametrize("parts", [1, 5])
def test_manifest_equals_brute_force(spark, name, parts):
    conf = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k) for k in conf}
    spark.conf.set(conf[0], "false")
    spark.conf.set(conf[1], str(parts))
    try:
        got = result(case(spark, TABLES[name]))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == brute(TABLES[name])


def test_edge_cases(messy, empty):
    assert result(messy) == brute([r[:5] for r in rows()])
    assert result(empty) == []


def test_trees_of_several_rounds(spark, monkeypatch):
    """Blocks of 8 leaves: each round builds one level."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    assert result(case(spark, TABLES["many"])) == brute(TABLES["many"])


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 700])
def test_octopus_is_minimal_and_sufficient(n):
    g = np.random.default_rng(n)
    leaves = [h(str(i)) for i in range(n)]
    root, levels = tree(leaves)
    for size in {1, min(3, n), n // 2 + 1, n}:
        chosen = np.sort(g.choice(n, size, replace=False))
        ask = merkle.octopus(chosen, n)
        assert len(set(ask)) == len(ask)
        known = {(0, int(p)) for p in chosen}
        needed = set()
        for p in chosen:
            for level in range(len(levels) - 1):
                run = int(p) >> 3 * (level + 1)
                needed |= {(level, q) for q in range(run * 8, min(run * 8 + 8, len(levels[level]))) if q != int(p) >> 3 * level}
                known.add((level + 1, run))
        # Asked: exactly what proofs need and no chosen leaf derives.
        assert set(ask) == needed - known
        proofs = merkle.Proofs({int(p): leaves[p] for p in chosen}, n, {(l, p): levels[l][p] for l, p in ask})
        assert proofs.root == root
        for p in chosen:
            want, folded = walk(levels, int(p), leaves[p])
            assert proofs.siblings(int(p)) == "".join(want) and proofs.fold(int(p), leaves[p]) == folded == root
            assert proofs.fold(int(p), h("other")) != root


def test_partitions_ask_once(spark):
    """Requests are per leaf partition, none for what its own leaves give."""
    table = [(i, "t", "en", "s", 1) for i in range(3000)]
    m = merkle.manifest(merkle.document_leaves(case(spark, table), F.lit(False)))
    assert merkle.requests(m.lower.blocks.join(m.groups, "tree")).count() == 0  # one block holds the tree
    m.lower.blocks = m.lower.blocks.withColumn("rows", F.filter("rows", lambda r: r["pos"] % 8 == 0))
    ask = merkle.requests(m.lower.blocks.join(m.groups, "tree")).collect()
    assert len(ask) == len({(r.block, r.level, r.pos) for r in ask}) and {r.level for r in ask} == {0}
    got = merkle.prove(m).collect()
    assert len(got) == 375 and all(r.verified for r in got)


def test_registered_query(spark):
    got = QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    have = sorted((tuple(r) for r in got.collect()), key=str)
    assert have == brute([tuple(r) for r in docs]) and {r[-1] for r in have} == {True, False}
