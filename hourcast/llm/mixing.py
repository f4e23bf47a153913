"""Mixing sources to target weights by a low-discrepancy schedule.

Slot ``j`` of the schedule draws the source into whose share of the cumulative
weights the golden-ratio point ``frac((j + 1) / phi)`` falls; slots are ranked
per source, and rank ``r`` reads block ``r mod n`` of the source's ``n`` blocks.
A source's blocks cut its documents, shuffled by a seeded hash, into runs of
``block_words`` words.  Prefix sums are taken in two levels (hash ranges within
a source, slot ranges of the schedule), so a source with a third of all rows is
never ordered by one task.

A block has ``BLOCK_WORDS`` words, or a 64th of its source where that is less, so
the words taken differ from the target by a 128th of the source at most.  The
schedule runs until each source has the slots its target asks for, never
more than two passes over its blocks, so no document is taken over twice.

Defined results: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own, last in the order; a source of size 0 has target
0; an empty table gives an empty mix.  Rows equal in ``doc_id``, source and text
are documents of their own, told apart by a number (``copy``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES, WORD_CLASS, materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK_WORDS = 16384
LEAST_BLOCKS = 64
GROUP_ROWS = 4096
SLOT_RANGE = 1 << 16
COPIES = 1024
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+"))).cast("long")


def numbered(docs: DataFrame) -> DataFrame:
    """A row per document (doc_id, source, size, key, copy) from rows of the first four:
    equal rows are counted, and given out again with a number, at most ``COPIES`` of them by
    one task."""
    names = ["doc_id", "source", "size", "key"]
    counted = materialise(docs.groupBy(*names).agg(F.count("*").alias("_m")), "mix-counts")
    runs = counted.withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("_m") - 1) / COPIES))))
    if (counted.agg(F.max("_m")).first()[0] or 0) > COPIES:
        runs = runs.repartition("doc_id", "key", "_c")
    last = F.least(F.col("_m"), (F.col("_c") + 1) * COPIES) - 1
    return runs.select(*names, F.explode(F.sequence(F.col("_c") * COPIES, last)).alias("copy"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: ``source_size``, ``weight`` and ``target``.

    ``target`` is ``min(cap * size, level * weight)``, with the level at which the
    targets add up to ``share`` of all sizes: sources in the order of the level
    that fills them are full up to the first that is not.  One row per source
    goes through one task (the sources are counted, not the documents)."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w)
    s = s.withColumn("_cap", F.col("source_size") * cap).withColumn("_fill", F.col("_cap") / F.col("weight"))
    upto = Window.orderBy("_fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("_full", F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
    s = s.withColumn("_open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    s = s.withColumn("_level", (F.sum("source_size").over(every) * share - F.col("_full")) / F.col("_open"))
    # The level of the first source, in that order, that its own level does not fill.
    turn = F.row_number().over(Window.orderBy("_fill", F.col("source").asc_nulls_last()))
    s = s.withColumn("_turn", turn)
    level = F.min(F.when(F.col("_level") <= F.col("_fill"), F.struct("_turn", F.col("_level").alias("level")))).over(every)["level"]
    s = s.withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0))
                     .otherwise(F.least(F.col("_cap"), F.coalesce(level * F.col("weight"), F.col("_cap")))))
    return s.select("source", "source_size", "weight", "target")


def blocks_of(goal: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``goal`` with each source's ``block`` length, number of ``blocks`` and the
    ``slots`` that bring it nearest its target."""
    size = F.col("source_size")
    g = goal.withColumn("block", F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor(size / LEAST_BLOCKS))).cast("long"))
    g = g.withColumn("blocks", F.ceil(size / F.col("block")).cast("long"))
    passes = F.floor(F.col("target") / size)
    slots = passes * F.col("blocks") + F.round((F.col("target") - passes * size) / F.col("block"))
    return g.withColumn("slots", F.when(size > 0, F.least(slots, 2 * F.col("blocks"))).otherwise(0).cast("long"))


def place(sizes: DataFrame, seed: int = 17) -> DataFrame:
    """Documents (doc_id, source, size, key, copy) of positive size with ``start``: the
    words before the document in its source's shuffled order."""
    groups = max(1, -(-sizes.count() // GROUP_ROWS))
    d = sizes.filter(F.col("size") > 0).withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "key", "copy"))
    # Ranges of the hash: ordered by range, then within it, they are ordered by hash.
    d = d.withColumn("_g", F.floor((F.shiftright("_h", 32) + (1 << 31)) * groups / (1 << 32)))
    totals = d.groupBy("source", "_g").agg(F.sum("size").alias("_t"))
    before = Window.partitionBy("source").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("_s"), F.col("_g").alias("_g2"),
                           F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("source", "_g").orderBy("_h", "doc_id", "key", "copy").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    d = d.join(totals, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_g") == F.col("_g2")))
    return d.select("doc_id", "source", "size", "key", "copy", (F.col("_base") + F.col("_in")).alias("start"))


def schedule(goal: DataFrame) -> DataFrame:
    """The schedule (slot, source, pass, block_no): golden-ratio points through the
    cumulative shares of slots, slots ranked per source; ``goal`` as from ``blocks_of``.

    A point finds its source by an equality join on cells of the unit interval.
    A source's points arrive at its share but for O(log slots), so there are
    somewhat more slots than drawn; ranks beyond a source's own slots are left out.
    """
    spark = goal.sparkSession
    g = goal.filter("slots > 0")
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("_sum", F.sum("slots").over(upto)).withColumn("_all", F.sum("slots").over(every))
    g = g.select("source", "blocks", "slots", ((F.col("_sum") - F.col("slots")) / F.col("_all")).alias("_lo"),
                 (F.col("_sum") / F.col("_all")).alias("_hi"))
    total = g.agg(F.count("*").alias("k"), F.sum("slots").alias("n"), F.min("slots").alias("least")).first()
    n = total["n"] or 0
    # The discrepancy of n golden-ratio points is below 3 log2(n) + 4 points.
    points = n + (3 * n.bit_length() + 4) * n // total["least"] + 1 if n else 0
    cells = 4 * max(total["k"], 256)
    span = F.sequence(F.floor(F.col("_lo") * cells), F.least(F.floor(F.col("_hi") * cells), F.lit(cells - 1)))
    g = g.withColumn("_cell", F.explode(span))
    slots = spark.range(points).select(F.col("id").alias("slot"), F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0)).alias("_x"))
    slots = slots.withColumn("_cell", F.floor(F.col("_x") * cells))
    slots = slots.join(g, "_cell").filter("_lo <= _x and _x < _hi").withColumn("_g", F.floor(F.col("slot") / SLOT_RANGE))
    counts = slots.groupBy("_lo", "_g").agg(F.count("*").alias("_c"))
    before = Window.partitionBy("_lo").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_lo", "_g", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    slots = slots.withColumn("_n", F.row_number().over(Window.partitionBy("_lo", "_g").orderBy("slot")))
    slots = slots.join(counts, ["_lo", "_g"]).withColumn("rank", F.col("_base") + F.col("_n") - 1).filter("rank < slots")
    return slots.select("slot", "source", F.floor(F.col("rank") / F.col("blocks")).alias("pass"),
                        F.pmod("rank", "blocks").alias("block_no"))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights=WEIGHTS,
        share: float = SHARE, cap: float = CAP, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): per document ``size``, ``source_size``, ``target`` and
    ``taken`` words; and what the mix takes, in the order of ``slot``: a row for
    each document and drawn block (doc_id, key, copy, source, slot, pass, block_no,
    first_word, words), ``key`` being the hash of the text and ``copy`` the number of an equal row."""
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                        word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("key"))
    sizes = materialise(numbered(sizes), "mix-sizes")
    goal = materialise(blocks_of(targets(sizes, weights, share, cap), block_words), "mix-targets")
    g = goal.select(F.col("source").alias("_s"), "source_size", "target", "block")
    at = place(sizes).join(g, F.col("source").eqNullSafe(F.col("_s")))
    start, size, block = F.col("start"), F.col("size"), F.col("block")
    parts = at.withColumn("block_no", F.explode(F.sequence(F.floor(start / block), F.floor((start + size - 1) / block))))
    begin = F.greatest(F.col("block_no") * block, start)
    end = F.least((F.col("block_no") + 1) * block, start + size)
    parts = parts.select("doc_id", "key", "copy", "source", "block_no", (begin - start).alias("first_word"), (end - begin).alias("words"))
    drawn = materialise(schedule(goal), "mix-schedule").withColumnRenamed("source", "_s").withColumnRenamed("block_no", "_b")
    spans = parts.join(drawn, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block_no") == F.col("_b")))
    spans = spans.select("doc_id", "key", "copy", "source", "slot", "pass", "block_no", "first_word", "words")
    taken = spans.groupBy(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("source").alias("_s"),
                          F.col("copy").alias("_y")).agg(F.sum("words").alias("taken"))
    out = sizes.join(taken, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("key").eqNullSafe(F.col("_k")) & (F.col("copy") == F.col("_y"))
                     & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_d", "_k", "_s", "_y")
    out = out.join(g, F.col("source").eqNullSafe(F.col("_s")), "left")
    return out.select("doc_id", "source", "key", "copy", "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), spans


def mixed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix as documents, columns of ``docs`` unchanged: a row for each time the
    whole document is taken, and one with its first words, up to the block's end,
    where the last pass over its source ends within it."""
    got, _ = mix(docs, text, doc_id, source, **options)
    got = got.filter("taken > 0").select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("source").alias("_s"),
                                         F.col("copy").alias("_y"), "taken", "size")
    names = [f"c{i}" for i in range(len(docs.columns))]
    col = {n: F.col(f"c{i}") for i, n in enumerate(docs.columns)}
    d = materialise(docs.toDF(*names).withColumn("_row", F.monotonically_increasing_id()), "mix-rows")
    same = ["_d2", "_k2", "_s2"]
    rows = d.select(col[doc_id].alias("_d2"), F.xxhash64(col[text]).alias("_k2"), col[source].cast("string").alias("_s2"), "_row")
    rows = materialise(rows, "mix-row-keys")
    groups = rows.groupBy(*same).agg(F.min("_row").alias("_row"), F.count("*").alias("_m"))
    lone = groups.filter("_m = 1").select(*same, "_row", F.lit(0).cast("long").alias("_copy"))
    # Equal rows are numbered in two steps, so many of them are no one task's.
    more = groups.filter("_m > 1").select(*[F.col(c).alias(f"{c}g") for c in same])
    more = rows.join(more, [F.col(c).eqNullSafe(F.col(f"{c}g")) for c in same], "left_semi")
    more = more.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(256)))
    more = more.withColumn("_in", F.row_number().over(Window.partitionBy(*same, "_salt").orderBy("_row")))
    base = more.groupBy(*same, "_salt").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*same).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select(*[F.col(c).alias(f"{c}b") for c in same], F.col("_salt").alias("_saltb"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_b"))
    more = more.join(base, [*[F.col(c).eqNullSafe(F.col(f"{c}b")) for c in same], F.col("_salt") == F.col("_saltb")])
    every = lone.unionByName(more.select(*same, "_row", (F.col("_b") + F.col("_in") - 1).alias("_copy")))
    got = every.join(got, F.col("_d2").eqNullSafe(F.col("_d")) & F.col("_k2").eqNullSafe(F.col("_k")) & F.col("_s2").eqNullSafe(F.col("_s"))
                     & (F.col("_copy") == F.col("_y")))
    d = d.join(got.select("_row", "taken", "size"), "_row")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    d = d.withColumn("_cut", F.explode(copies))
    # The part up to the end of word ``_cut``; white space before and between its words is kept.
    words = F.regexp_extract_all(col[text], F.lit(SPACE_CLASS + "*" + WORD_CLASS), F.lit(0))
    part = F.when(F.col("_cut") == 0, col[text]).otherwise(F.array_join(F.slice(words, F.lit(1), F.col("_cut")), ""))
    return d.select(*[(part if n == text else col[n]).alias(n) for n in docs.columns])
