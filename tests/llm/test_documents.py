"""Operators over documents against brute force, on a table of edge cases."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import prose, rows
from pyspark.sql import functions as F

import corpus_pipeline
from hourcast.llm import langid, line_dedup, mixing, near_dup, packing, quality, toxicity
from hourcast.llm.near_dup import HASHES, least_matches, links_in_block, survivors

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(t):
    return WORD.findall(t or "")


def repeat_words(w):
    c = Counter(zip(w, w[1:], w[2:]))
    return len({p for i in range(len(w) - 2) if c[w[i], w[i + 1], w[i + 2]] > 1 for p in (i, i + 1, i + 2)})


def test_quality_measures(messy, empty):
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.measure(messy).collect())
    want = []
    for i, t, *_ in rows():
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        want.append((i or 0, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat_words(w)))
    assert got == sorted(want)
    assert quality.measure(empty).count() == 0


def test_cascade_order_does_not_change_the_verdict(messy):
    verdicts = []
    for order in (quality.RULES, quality.RULES[::-1], quality.plan_cascade(messy)):
        out = quality.apply_cascade(messy, order)
        verdicts.append(sorted((r.doc_id or 0, r.text or "", r.rejected_by is None) for r in out.collect()))
    assert verdicts[0] == verdicts[1] == verdicts[2]
    assert quality.keep_documents(messy).count() == sum(v for *_, v in verdicts[0])


def test_quality_is_native(messy):
    plan = quality.measure(messy)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup(messy, empty):
    table, ws = rows(), " \t\n\x0b\x0c\r"
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(ws))
    held = {}
    for i, t, *_ in table:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                held.setdefault(key(x), set()).add(i)
    want = []
    for i, t, *_ in table:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(held.get(key(x), ())) < 5 or max(held[key(x)]) == i]
        want.append((i or 0, len(lines), len(lines) - len(kept), "\n".join(kept)))
    out = line_dedup.dedup_lines(messy)
    assert [c for c in out.columns if c not in messy.columns] == ["n_lines", "n_dropped"]
    assert sorted((r.doc_id or 0, r.n_lines, r.n_dropped, r.text or "") for r in out.collect()) == sorted(want)
    assert any(n for _, _, n, _ in want)
    assert line_dedup.dedup_lines(empty).count() == 0


def brute_components(table, k, percent):
    sets = {}
    for i, t, *_ in table:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if i is not None:
            sets[i] = {tuple(w)} if 0 < len(w) < k else {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_edge_cases(messy, empty, k):
    got = near_dup.near_duplicates(messy, k=k).collect()
    want = brute_components(rows(), k, 80)
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)
    assert near_dup.near_duplicates(empty).count() == 0


def family(n):
    """A large group of near copies, with members on both sides of the threshold."""
    base = [f"w{i}" for i in range(120)]
    rng = np.random.default_rng(5)
    out = []
    for i in range(n):
        w = list(base)
        for j in rng.choice(120, int(rng.integers(0, 7)), replace=False):
            w[j] = f"x{rng.integers(0, 400)}"
        out.append((i, " ".join(w)))
    return out


def test_near_duplicates_hot_group(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", 60)
    table = family(260)
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df, k=4).collect()}
    want = {i: c for i, (_, c) in brute_components(table, 4, 80).items()}
    assert got == want and len(set(want.values())) > 5


def test_texts_of_one_id_are_documents_of_their_own(spark):
    a, b = prose(90, 1), prose(90, 40)[::-1]
    table = [(1, a), (1, b), (1, b), (2, a + " end"), (3, b + " end"), (3, b + " end")]
    d = spark.createDataFrame(table, "doc_id long, text string").repartition(2)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(d).collect())
    assert got == [(1, 1, True)] * 3 + [(2, 1, False)] + [(3, 1, False)] * 2
    left = sorted(tuple(r) for r in near_dup.distinct_documents(d).collect())
    assert left == sorted([(1, a), (1, b)])


def test_pruning_bound():
    assert all(0 < m < n for n, m in least_matches())
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (2000, HASHES)).astype(np.uint8)
    near = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 256, a.shape)).astype(np.uint8)
    far = np.where(rng.random(a.shape) < 0.3, a, rng.integers(0, 256, a.shape)).astype(np.uint8)
    assert len(survivors(a, near, 80)) == 2000 and len(survivors(a, far, 80)) == 0


def test_targets_and_taken(spark, messy, empty):
    got, spans = mixing.mix(messy)
    r = got.toPandas()
    sizes = {(i, t): len(words(t)) for i, t, *_ in rows()}
    assert sorted(r["size"]) == sorted(len(words(t)) for i, t, s in {(i, t, s) for i, t, _, s, *_ in rows()})
    assert (r.taken <= 2 * r["size"]).all() and sum(sizes.values()) > 0
    by = r.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "max"), taken=("taken", "sum"))
    assert (by.target <= 2 * by["size"] + 1e-6).all()
    assert abs(by.target.sum() - 1.5 * by["size"].sum()) < 1e-6
    assert (abs(by.taken - by.target) <= np.maximum(1, by["size"] / 64)).all()
    assert spans.groupBy("slot").agg(F.countDistinct("source").alias("n")).filter("n > 1").count() == 0
    assert mixing.mix(empty)[0].count() == 0
    again = mixing.mix(messy.repartition(7))[0].toPandas()
    key = ["doc_id", "source", "key"]
    assert r.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))


def test_mixed_documents_take_the_words(messy):
    got, _ = mixing.mix(messy)
    want = got.agg(F.sum("taken")).first()[0]
    out = mixing.mixed_documents(messy)
    assert out.columns == messy.columns
    assert out.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == want
    once = messy.dropDuplicates(["doc_id", "text", "source"])
    assert mixing.mixed_documents(once).select(F.sum(mixing.word_count(F.col("text")))).first()[0] == \
        mixing.mix(once)[0].agg(F.sum("taken")).first()[0]


def test_repeated_rows_are_mixed_as_documents(spark, monkeypatch):
    """Each of the equal rows has its size, its row in the result and at most two uses."""
    monkeypatch.setattr(mixing, "COPIES", 8)
    table = [(i, prose(60, i), "en", f"s{i % 3}") for i in range(30)] + [(3, prose(60, 3), "en", "s0")] * 20
    d = spark.createDataFrame(table, "doc_id long, text string, lang string, source string").repartition(3)
    rows = mixing.mix(d)[0].collect()
    assert len(rows) == 50 and sum(r.size for r in rows) == 50 * 60
    assert {r.source: r.source_size for r in rows} == {"s0": 30 * 60, "s1": 600, "s2": 600}
    out = mixing.mixed_documents(d)
    assert out.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in rows)
    assert all(r.taken <= 2 * r.size for r in rows)
    # A repeated row is one of 21 documents: it comes out at most twice for each of them.
    assert out.groupBy("doc_id").count().filter("count > 2 and doc_id <> 3 or count > 42").count() == 0


def brute_mix(rows, weights=(3, 1, 2), share=1.5, cap=2.0, block_words=16384, least=64):
    """Words taken per (doc_id, key, copy) of rows (doc_id, source, size, key, copy, hash)."""
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s))
    size = {s: sum(r[2] for r in rows if r[1] == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {s: 0.0 for s in names}, share * sum(size.values()), [s for s in names if size[s]]
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= cap * size[s]]
        for s in over or open_:
            target[s] = cap * size[s] if over else level * weight[s]
            left -= target[s]
        open_ = [s for s in open_ if s not in over] if over else []
    block = {s: min(block_words, max(1, size[s] // least)) for s in names}
    blocks = {s: -(-size[s] // block[s]) for s in names}
    slots = {}
    for s in names:
        if size[s]:
            passes = int(target[s] // size[s])
            slots[s] = min(passes * blocks[s] + int((target[s] - passes * size[s]) / block[s] + 0.5), 2 * blocks[s])
    total, drawn, j = sum(slots.values()), {s: [] for s in slots}, 0
    edges, at = {}, 0
    for s in names:
        if slots.get(s):
            edges[s] = (at / total, (at + slots[s]) / total)
            at += slots[s]
    while any(len(drawn[s]) < slots[s] for s in edges):
        x = ((j + 1) * mixing.GOLDEN) % 1.0
        for s, (lo, hi) in edges.items():
            if lo <= x < hi and len(drawn[s]) < slots[s]:
                drawn[s].append(j)
        j += 1
    taken, spans = {}, set()
    for s in edges:
        start, place = 0, []
        for r in sorted((r for r in rows if r[1] == s and r[2]), key=lambda r: (r[5], r[0] is not None, r[0] or 0, r[3], r[4])):
            place.append((start, start + r[2], r))
            start += r[2]
        for rank, slot in enumerate(drawn[s]):
            n = rank % blocks[s]
            for lo, hi, r in place:
                words = min(hi, (n + 1) * block[s]) - max(lo, n * block[s])
                if words > 0:
                    taken[r[0], r[3], r[4]] = taken.get((r[0], r[3], r[4]), 0) + words
                    spans.add((r[0], r[4], s, slot, rank // blocks[s], n, words))
    return target, taken, spans


def test_mix_equals_brute_force(spark, messy):
    """Targets, slots in order, ranks, blocks and words of every document."""
    table = [(i, prose(5 + i * 7 % 90, i), f"s{i % 5}") for i in range(120)] + [(7, prose(30, 1), "tiny"), (7, prose(30, 1), "tiny"), (500, "a", None)]
    for d in (messy, spark.createDataFrame(table, "doc_id long, text string, source string")):
        got, spans = mixing.mix(d)
        hashed = F.xxhash64(F.lit(17), "doc_id", "key", "copy")
        rows = got.withColumn("h", hashed).collect()
        target, taken, want = brute_mix([(r.doc_id, r.source, r["size"], r.key, r["copy"], r.h) for r in rows])
        for r in rows:
            assert r.target == pytest.approx(target[r.source])
            assert r.taken == taken.get((r.doc_id, r.key, r["copy"]), 0)
        assert {(r.doc_id, r["copy"], r.source, r.slot, r["pass"], r.block_no, r.words) for r in spans.collect()} == want


def test_packing(messy, empty):
    from tokenizers import Tokenizer
    path = packing.tokenizer_path()
    full = Tokenizer.from_file(path)
    want = Counter()
    for i, t, *_ in rows():
        ids = np.array(full.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            want[i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())] += 1
    got = packing.pack_documents(messy).toPandas()
    assert Counter((None if np.isnan(a) else int(a), *map(int, b)) for a, *b in
                   zip(got.doc_id.astype(float), got.piece, got.start, got.length, got.ids_crc32)) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()][:-1] and g.length.sum() <= 2048
    assert packing.pack_documents(empty).count() == 0


def test_equal_rows_are_dealt_over_all_groups(spark):
    d = spark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))
    got = packing.pack_documents(d, group_pieces=100).toPandas()
    sizes = (got.sequence_id // 2**32).value_counts()
    assert len(got) == 600 and len(sizes) == 6 and sizes.max() < 200


def test_sequences_round_trip(messy):
    d = messy.filter("doc_id is not null").dropDuplicates(["doc_id"])
    packed = packing.pack_documents(d)
    seqs = {r.sequence_id: np.array(r.ids, "<u4") for r in packing.sequences(d, packed).collect()}
    for r in packed.collect():
        assert zlib.crc32(seqs[r.sequence_id][r.offset:r.offset + r.length].tobytes()) == r.ids_crc32


def test_tokens_of_odd_texts():
    tokens = packing.WordTokenizer(packing.tokenizer_path(), cache_words=50)
    rng, alphabet = np.random.default_rng(1), list("abXY01 '\"<>|.,!\t\n\x0b\x1c\x85\xa0éÉßø÷ªº̈ΣσİǅЖ中😀‍'s're\x00\x01")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 50))) for _ in range(1500)] + ["a<|endoftext|>b", "it's WE'RE"]
    for got, e in zip(tokens.ids(texts), tokens.full.encode_batch(texts, add_special_tokens=False)):
        assert got == np.array(e.ids, "<u4").tobytes()


def least_bins(sizes, limit):
    """Fewest bins by trying every placement."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= limit and bins[b] not in bins[:b]:
                bins[b] += sizes[i]
                go(i + 1, bins)
                bins[b] -= sizes[i]
        go(i + 1, bins + [sizes[i]])

    go(0, [])
    return best


def test_bin_completion_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = sorted(rng.integers(10, 70, rng.integers(1, 10)).tolist(), reverse=True)
        bins = packing.complete_bins(sizes, 100, nodes_per_bin=500)
        assert sorted(x for b in bins for x in b) == sorted(sizes) and max(map(sum, bins)) <= 100
        assert packing.lower_bound(sizes, 100) <= least_bins(sizes, 100) == len(bins)


def test_search_revisits_the_first_bins():
    # Production budget; best fit takes 177 bins, and a budget of one dive no fewer.
    sizes = np.random.default_rng(5).integers(410, 690, 600).tolist()
    bins = packing.complete_bins(sizes)
    assert sorted(x for b in bins for x in b) == sorted(sizes) and max(map(sum, bins)) <= 2048
    first, least = len(packing.best_fit(sizes, 2048)), packing.lower_bound(sizes, 2048)
    assert len(bins) - least <= (first - least) / 3


def test_fillings_of_many_pieces_and_fullest_first():
    found, whole = packing.fillings([1], {1: 3000}, 2000, 4, 100)
    assert found == [(1,) * 2000] and whole
    found, whole = packing.fillings([3, 5, 7, 8], {3: 2, 5: 1, 7: 1, 8: 1}, 10, 4, 100)
    assert found == [(7, 3), (8,)] and whole  # 5 with 3 could take 7 instead
    assert not packing.fillings(list(range(50, 300)), dict.fromkeys(range(50, 300), 1), 2000, 4, 100)[1]


def test_language_spans(spark, messy, empty):
    de = "der hund und die katze gehen nicht durch das haus weil es dunkel ist"
    en = "the dog and the cat are walking through this house while the light is on"
    ru = "собака и кошка идут через тёмный дом"
    train = spark.createDataFrame([(de, "de"), (en, "en"), (ru, "ru")], "text string, lang string")
    model = langid.train(train)
    mixed = en + " " + de + " " + ru
    d = spark.createDataFrame([(1, mixed), (2, None), (3, "12 34 !"), (4, ru), (5, "кот"), (6, "«»")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(d, model).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de", "ru"]
    assert [s.words for s in got[1].spans] == [len(x.split()) for x in (en, de, ru)]
    assert (got[2].lang_pred, got[3].lang_pred, got[6].lang_pred) == ("und",) * 3 and got[2].score == 0.0
    assert (got[4].lang_pred, got[5].lang_pred) == ("ru", "ru")
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.train(empty) is None and langid.identify(messy, None).filter("lang_pred != 'und'").count() == 0
    out = langid.identify(messy, langid.train(messy))
    assert out.count() == len(rows()) and langid.identify(empty, model).count() == 0


def test_language_of_unlisted_scripts(spark):
    ka, my = "ძაღლი და კატა სახლში მიდიან", "ခွေးနှင့်ကြောင်သည် အိမ်ထဲသို့ သွားသည်"
    model = langid.train(spark.createDataFrame([("the dog and the cat", "en"), (ka, "ka"), (my, "my")], "text string, lang string"))
    d = spark.createDataFrame([(1, "კატა და ძაღლი"), (2, "ကြောင်သည် သွားသည်"), (3, "😀 ™ —")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(d, model).collect()}
    assert got == {1: ("ka", 1.0), 2: ("my", 1.0), 3: ("und", 0.0)}


def test_viterbi_against_brute_force():
    rng = np.random.default_rng(2)
    model = langid.Model.__new__(langid.Model)
    model.langs = ["a", "b", "c"]
    lengths = [0, 1, 5, 7, 3, 0, 6]
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    scores = rng.normal(0, 3, (bounds[-1], 3)).astype(np.float32)
    label = model.path(scores, bounds, 2.0)

    def total(path, s):
        return sum(s[i, x] for i, x in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))

    from itertools import product
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            best = max(total(p, scores[a:b].astype(float)) for p in product(range(3), repeat=int(b - a)))
            assert abs(total(label[a:b].tolist(), scores[a:b].astype(float)) - best) < 1e-4


def test_toxicity(spark, messy, empty):
    toxic = [prose(40, i) + (" grumblefoo" if i % 2 else " nastybarling") for i in range(40)]
    clean = [prose(40, i + 100) for i in range(300)] + [prose(30, i) + " grumblefoo" for i in range(30)]
    model = toxicity.fit_pu(toxic, clean, 0.12)
    s = model.scores([prose(50, 7) + " Grumblefoo!", prose(20, 8) + " nastybarly", prose(50, 9), None, ""])
    assert (s[:2] >= 0.3).all() and (s[2:] < 0.3).all()
    assert toxicity.fit_pu([], clean, 0.0).scores(["x"])[0] < 0.3
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    out = toxicity.score(messy, toxicity.learn(messy, labels))
    assert out.count() == len(rows()) and out.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(empty, toxicity.learn(empty, labels.limit(0))).count() == 0


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit_pu", lambda t, u, prior: seen.append((sorted(t), sorted(u))))
    ids = [r.i for r in spark.range(200).select(F.col("id").alias("i")).filter(toxicity.fold_of(F.col("i")) != 2).collect()]
    table = [(ids[0], "again")] * 300 + [(ids[0], f"other {i}") for i in range(30)] + [(i, f"text {i}") for i in ids[1:]]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(ids[0], 1), (ids[1], 1), (ids[2], 0)], "doc_id long, toxic int")
    toxicity.learn(docs, labels, max_toxic=10, max_unlabelled=500)
    assert len(seen[0][0]) == 10 and seen[0][1] == sorted(t for _, t in set(table))


def test_pipeline(spark, tmp_path):
    table = [(i, prose(80, i % 17) + f" tail{i % 40} " * (i % 5), "en", f"s{i % 3}", 1) for i in range(120)]
    table += [(200 + i, "word " * 200, "en", "s1", 1) for i in range(3)]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert kept.columns == columns and kept.filter("doc_id >= 200").count() == 0
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        assert docs.columns == columns, name
    want = brute_components([(i, t) for i, t, *_ in table if i < 200], 5, 80)
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(got.doc_id) <= {c for _, c in want.values()} and len(got)
    blank = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, blank, str(tmp_path)).count() == 0


def test_links_in_block_skips_what_earlier_bands_have():
    import pandas as pd
    s = np.sort(near_dup.mix(np.arange(1, 51, dtype=np.uint64)))
    sig = near_dup.signatures(s, np.array([50]))[0].astype(np.uint8).tobytes()
    g = pd.DataFrame({"band": [3, 3], "bk": [0, 0], "rep": [1, 2], "comp": [1, 2], "n": [50, 50], "sig": [sig] * 2,
                      "bands": [list(range(32))] * 2, "set": [s.tobytes()] * 2})
    assert links_in_block(g, 80, 0, 0) == []
    assert links_in_block(g.assign(band=0), 80, 0, 0) == [(1, 2)]


def test_kept_text_hash(spark):
    d = spark.createDataFrame([(1, "é\n\n")], "doc_id long, text string")
    got = line_dedup.dedup_lines(d).select(F.sha2("text", 256).alias("h")).first().h
    assert got == hashlib.sha256("é\n\n".encode()).hexdigest()


def test_fullest_filling_against_brute_force():
    rng = np.random.default_rng(11)
    for _ in range(200):
        open_sizes = rng.integers(1, 40, rng.integers(1, 9)).tolist()
        room = int(rng.integers(0, 90))
        counts = {s: open_sizes.count(s) for s in open_sizes}
        got = packing.fullest(sorted(counts), counts, room)
        sets = [tuple(sorted((s for i, s in enumerate(open_sizes) if m >> i & 1), reverse=True)) for m in range(1 << len(open_sizes))]
        fits = [f for f in sets if sum(f) <= room]
        assert tuple(got) == max(fits, key=lambda f: (sum(f), f))
    assert packing.fullest([1], {1: 5000}, 2000) == [1] * 2000 and packing.fullest([], {}, 5) == []


def test_lower_bound_of_two_to_a_bin():
    # Volume says 80; pieces of over a third of a bin go two to a bin.
    assert packing.lower_bound([700] * 232, 2048) == 116


def test_cascade_samples_any_frame(spark, messy):
    """Renamed, filtered and joined frames are sampled themselves."""
    path = __import__("tempfile").mkdtemp() + "/t"
    messy.write.parquet(path)
    stored = spark.read.parquet(path)
    want = sorted(str(r.doc_id) for r in quality.keep_documents(messy).collect())
    assert sorted(str(r.doc_id) for r in quality.keep_documents(stored.withColumnRenamed("text", "t2"), "t2").collect()) == want
    joined = stored.join(stored.select(F.col("doc_id").alias("d2")).distinct(), F.col("doc_id").eqNullSafe(F.col("d2")))
    assert sorted(str(r.doc_id) for r in quality.keep_documents(joined).collect()) == want
    assert quality.sample_of(stored.filter("doc_id = 1"), "text").count() == 1
    assert quality.plain_files(stored) and quality.plain_files(stored.select("doc_id", "text"))
    for other in (stored.withColumnRenamed("text", "t2"), joined, stored.filter("doc_id = 1"), messy, stored.select(F.upper("text").alias("text"))):
        assert not quality.plain_files(other)


def test_language_vote_counts_letters_of_the_majority_script(spark):
    en, ru = "the dog and the cat are walking through this house", "собака и кошка идут через тёмный дом и лес"
    zh = "狗和猫在黑暗的房子里走路因为天黑了"
    model = langid.train(spark.createDataFrame([(en, "en"), (ru, "ru"), (zh, "zh")], "text string, lang string"))

    def label(text):
        d = spark.createDataFrame([(1, text, "y", 2)], "doc_id long, text string, spans string, score int")
        return langid.identify(d, model).first()

    # 34 Latin letters against 25 Cyrillic ones of two bytes each.
    latin, cyrillic = "the dog and the cat are walking there this ", "собака и кошка идут через лес"
    a, b = (sum(map(str.isalpha, t)) for t in (latin, cyrillic))
    r = label(latin + cyrillic)
    assert b < a < 2 * b and r.lang_pred == "en" and r.score == pytest.approx(a / (a + b))
    # Unspaced text of two scripts, and punctuation and spaces beyond ASCII.
    r = label("狗和猫在黑暗的the dog and the cat are walking狗和猫在")
    assert [s.lang for s in r.spans] == ["zh", "en", "zh"] and r.lang_pred == "en"
    r = label("собака\u00a0и\u3000кошка—идут«через»the。dog")
    assert sum(s.words for s in r.spans) == 7
    # A stray letter of another script leaves a word its majority's.
    c = langid.Batch([langid.parted("ab\u0301cdefж".encode()), "abc".encode()])
    assert langid.Batch(["abcжdef".encode()]).word_scripts()[0].tolist() == [1] and len(c.start) == 3


def test_language_of_a_long_text(spark):
    """A text of several pieces and one word without end give what a few words give."""
    en, ru = "the dog and the cat are walking through this house ", "собака и кошка идут через тёмный дом "
    model = langid.train(spark.createDataFrame([(en, "en"), (ru, "ru")], "text string, lang string"))
    old = langid.PIECE_BYTES, langid.CELLS
    texts = [en * 40 + ru * 9, ru * 60, "x" * 5000 + "ж" * 100, None, ""]
    want = [a.tolist() for a in model.words(texts)[1:]]
    scores = model.words(texts)[0]
    assert langid.pieces((en * 40).encode(), 300)[0].decode() + "".join(p.decode() for p in langid.pieces((en * 40).encode(), 300)[1:]) == en * 40
    assert all(p.decode() for p in langid.pieces("ж".encode() * 500, 101))
    try:
        langid.CELLS = 64
        few = model.words(texts)
        assert [a.tolist() for a in few[1:]] == want and np.allclose(few[0], scores, rtol=1e-4, atol=1e-3)
    finally:
        langid.PIECE_BYTES, langid.CELLS = old
    # Counts of a text do not depend on where it is cut.
    whole, cut = (model.words([(en * 40)[:n]])[1].sum() for n in (None, None))
    assert whole == cut == sum(map(str.isalpha, en * 40))


def brute_keep(t):
    """Whether a text passes the quality rules."""
    w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
    chars = sum(map(len, w))
    upper = sum(unicodedata.category(c) == "Lu" for c in t or "")
    return not (len(w) < 50 or 100 * repeat_words(w) > 50 * len(w) or 10 * len(re.findall(r"[#*$%&|<>]", t or "")) > len(w) or 100 * upper > 40 * chars
                or 100 * (len(lines) - len(set(lines))) > 50 * len(lines) or chars > 20 * len(w))


def brute_lines(table):
    """(id, text, ...) rows without the lines that another document keeps."""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t, *_ in table:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                held.setdefault(key(x), set()).add(i)
    return [(i, "\n".join(x for x in (t or "").split("\n") if i is None or len(held.get(key(x), ())) < 5 or max(held[key(x)]) == i), *rest)
            for i, t, *rest in table]


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Every stage on what its predecessor keeps: the same pieces of the same documents, and bins
    no more than best fit takes."""
    shared = "A line that many of the documents share, well over forty characters long"
    table = [(i, prose(70 + i % 30, i) + f" own{i} " * (i % 4), "en", f"s{i % 3}", i) for i in range(60)]
    table += [(100 + i, f"{shared}\n{prose(90, 40 + i)} end{i}", "de", "s0", None) for i in range(7)]
    table += [(200 + i, prose(120, 3) + f" x{i}", None, None, 1) for i in range(6)] + [(300, "too short", "en", "s1", 1), (301, None, None, None, None)]
    table += [(302, prose(3000, 5), "en", "s2", 1), (5, table[5][1], "en", "s2", 5), (303, "SHOUT " * 60, "en", "s1", 1), (304, "same words here " * 40, "en", "s1", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(table, schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    kept = brute_lines([r for r in table if brute_keep(r[1])])
    groups = brute_components(kept, 5, 80)
    once = {}
    for r in kept:
        if groups[r[0]][1] == r[0]:
            once.setdefault(r[0], r)
    assert 40 < len(once) < len(kept) < len(table)
    d = spark.createDataFrame(list(once.values()), schema)
    keyed = d.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("key"), F.lit(0).cast("long").alias("copy"))
    keyed = keyed.withColumn("h", F.xxhash64(F.lit(17), "doc_id", "key", "copy")).collect()
    _, taken, _ = brute_mix([(r.doc_id, r.source, r["size"], r.key, r["copy"], r.h) for r in keyed])
    tokens = packing.loaded(packing.tokenizer_path()).full
    want = []
    for (i, _, _), n in taken.items():
        t = once[i][1]
        w = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", t)
        for text in [t] * (n // len(w)) + (["".join(w[:n % len(w)])] if n % len(w) else []):
            ids = tokens.encode(text, add_special_tokens=False).ids + [0]
            for k, a in enumerate(range(0, len(ids), 2048)):
                part = ids[a:a + 2048]
                want.append((i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(spots)]).tolist()]
        assert [a for a, _ in sorted(spots)] == ends[:-1] and ends[-1] <= 2048
    assert packing.lower_bound([w[3] for w in want], 2048) <= len(bins) <= len(packing.best_fit([w[3] for w in want], 2048))


def test_toxicity_risk_and_gradient_by_finite_differences():
    rng = np.random.default_rng(2)
    n_features, signs = 6, set()
    for prior in (0.05, 0.3, 0.9):
        for _ in range(6):
            def side(n):
                pairs = np.argwhere(rng.random((n, n_features)) < 0.4)
                return pairs[:, 1], pairs[:, 0], n
            xp, xu = side(9), side(14)
            w, c = rng.normal(size=n_features), rng.normal()

            def parts(w, c):
                def mean(x, sign):
                    m = [c + sum(w[f] for f, t in zip(x[0], x[1]) if t == i) for i in range(x[2])]
                    return np.mean([1 / (1 + np.exp(sign * v)) for v in m])
                return prior * mean(xp, 1), mean(xu, -1) - prior * mean(xp, -1)

            toxic, bracket = parts(w, c)
            value, grad = toxicity.risk(xp, xu, w, c, prior)
            assert value == pytest.approx(toxic + max(bracket, 0))
            signs.add(bracket < 0)
            for k in range(n_features + 1):
                step = np.eye(n_features + 1)[k] * 1e-6
                up, down = (parts(w + d[:-1], c + d[-1]) for d in (step, -step))
                slope = [(u - v) / 2e-6 for u, v in zip(up, down)]
                # Below zero the bracket alone is stepped back.
                assert grad[k] == pytest.approx(-slope[1] if bracket < 0 else sum(slope), abs=1e-7)
    assert signs == {True, False}
