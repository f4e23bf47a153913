"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is a boolean expression over the text.  ``plan_cascade`` runs the
rules on a sample to measure what each costs and rejects, and orders them by
rejections per unit of cost among the rows that earlier rules left; the order
changes the cost of the cascade, never its verdict.  ``apply_cascade`` turns
the order into one CASE, whose branches Spark evaluates lazily: a document that
a cheap rule rejects never reaches the dear ones.

Defined results: a null or empty text has no words, every measure 0, and is
rejected as too short.  Ties and repeated rows are judged row by row.  Columns
of the input pass through; the verdict column's name is a parameter.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES, materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_10_WORDS = 1
MAX_UPPER_PERCENT = 40
MAX_DUP_LINE_PERCENT = 50
MAX_WORD_CHARS = 20
SAMPLE_ROWS = 2000


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound as a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_list(text: Column) -> Column:
    t = F.btrim(text_of(text), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_CLASS + "+"))


def n_words(text: Column) -> Column:
    return F.size(word_list(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text_of(text), SPACE_CLASS + "+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text_of(text), r"[^#*$%&|<>]+", "")).cast("long")


def n_upper(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text_of(text), r"\P{Lu}+", "")).cast("long")


def lines_with_word(text: Column) -> Column:
    return F.filter(F.split(text_of(text), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def n_dup_lines(text: Column) -> Column:
    return let(lines_with_word(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice.

    Windows are hashed, (hash, position) pairs sorted, and positions whose
    neighbour has the same hash marked; the union of marked windows has
    ``min(3, gap to the next marked one)`` words for each.  O(n log n).
    """
    def windows(w):
        n = F.greatest(F.size(w) - 2, F.lit(0))
        return F.transform(F.arrays_zip(F.slice(w, F.lit(1), n).alias("a"), F.slice(w, F.lit(2), n).alias("b"),
                                        F.slice(w, F.lit(3), n).alias("c")), lambda x: F.xxhash64(x))

    def marked(s):
        after = F.slice(s, F.lit(2), F.size(s))
        near = F.filter(F.zip_with(s, after, lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"]))),
                        lambda x: x.isNotNull())
        return F.sort_array(F.array_distinct(F.flatten(near)))

    def covered(m):
        gaps = F.zip_with(m, F.slice(m, F.lit(2), F.size(m)), lambda x, y: F.least(F.coalesce(y - x, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def repeated(h):
        s = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(let(s, marked), covered))

    return let(windows(words), repeated).cast("long")


@dataclass(frozen=True)
class Rule:
    """``fails(text)`` is true where the rule rejects a text."""

    name: str
    fails: object


RULES = [
    Rule("too_short", lambda t: n_words(t) < MIN_WORDS),
    Rule("repeats", lambda t: let(word_list(t), lambda w: 100 * n_repeat_words(w) > MAX_REPEAT_PERCENT * F.size(w))),
    Rule("symbols", lambda t: 10 * n_symbols(t) > MAX_SYMBOLS_PER_10_WORDS * n_words(t)),
    Rule("shouting", lambda t: 100 * n_upper(t) > MAX_UPPER_PERCENT * word_chars(t)),
    Rule("dup_lines", lambda t: 100 * n_dup_lines(t) > MAX_DUP_LINE_PERCENT * F.size(lines_with_word(t))),
    Rule("long_words", lambda t: word_chars(t) > MAX_WORD_CHARS * n_words(t)),
]


def plain_files(docs: DataFrame) -> list[str]:
    """The files of a frame that is a Parquet scan with nothing but a choice of columns
    above it, under the names in the files; none for any other frame."""
    node = docs._jdf.queryExecution().optimizedPlan()
    if node.nodeName() == "Project" and " AS " not in node.toString().splitlines()[0]:
        node = node.children().apply(0)
    return sorted(docs.inputFiles()) if node.toString().startswith("Relation ") and node.toString().endswith(" parquet\n") else []


def sample_of(docs: DataFrame, text: str, rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """About ``rows`` texts of the frame: a seeded row sample, of two files chosen by the seed
    where the frame is a plain scan (the others are never opened), else of all its rows.  It
    only steers the order of the rules."""
    files = plain_files(docs)
    part = docs
    if files:
        part = docs.sparkSession.read.parquet(*[files[i] for i in sorted({seed % len(files), (seed * 31 + 5) % len(files)})])
    total = part.select(F.lit(1)).count()
    return part.select(F.col(text).alias("t")).sample(min(1.0, rows / max(total, 1)), seed)


def plan_cascade(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None,
                 sample: DataFrame | None = None) -> list[Rule]:
    """The rules in the order of rejections per cost, measured on a sample."""
    rules = RULES if rules is None else rules
    s = materialise(sample_of(docs, text) if sample is None else sample.select(F.col(text).alias("t")), "quality-sample")

    def seconds(*columns):
        began = time.perf_counter()
        s.agg(*[F.count_if(c) for c in columns]).collect()
        return time.perf_counter() - began

    base = min(seconds(F.col("t").isNull()) for _ in range(2))
    cost = {r.name: max(min(seconds(r.fails(F.col("t"))) for _ in range(2)) - base, 1e-3) for r in rules}
    verdicts = F.struct(*[r.fails(F.col("t")).alias(r.name) for r in rules])
    left = [(row["v"].asDict(), row["n"]) for row in s.groupBy(verdicts.alias("v")).agg(F.count("*").alias("n")).collect()]
    order, rest = [], list(rules)
    while rest:
        best = max(rest, key=lambda r: (sum(n for v, n in left if v[r.name]) / cost[r.name], -cost[r.name]))
        order.append(best)
        rest.remove(best)
        left = [(v, n) for v, n in left if not v[best.name]]
    return order


def apply_cascade(docs: DataFrame, order: list[Rule], text: str = "text", out: str = "rejected_by") -> DataFrame:
    """``docs`` with the name of the first rule that rejects the row (null: kept)."""
    verdict = F.lit(None).cast("string")
    for r in reversed(order):
        verdict = F.when(r.fails(F.col(text)), F.lit(r.name)).otherwise(verdict)
    return docs.withColumn(out, verdict)


def keep_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, columns unchanged."""
    order = plan_cascade(docs, text)
    verdict = F.lit(True)
    for r in reversed(order):
        verdict = F.when(r.fails(F.col(text)), F.lit(False)).otherwise(verdict)
    return docs.filter(verdict)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document with every measure and the cascade's verdict
    (``rejected_by``, null for kept documents); needs a column ``doc_id``."""
    order = plan_cascade(docs, text)
    m = docs.select("doc_id", F.col(text).alias("_t"), word_list(F.col(text)).alias("_w"))
    m = m.select("doc_id", "_t", F.size("_w").cast("long").alias("n_words"), word_chars(F.col("_t")).alias("word_chars"),
                 n_symbols(F.col("_t")).alias("n_symbols"), n_dup_lines(F.col("_t")).alias("n_dup_lines"),
                 n_repeat_words(F.col("_w")).alias("n_repeat_words"))
    # Rules over measures that are already there read those; the others stay lazy.
    known = {
        "too_short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > MAX_SYMBOLS_PER_10_WORDS * F.col("n_words"),
        "long_words": F.col("word_chars") > MAX_WORD_CHARS * F.col("n_words"),
        "shouting": 100 * n_upper(F.col("_t")) > MAX_UPPER_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.size(lines_with_word(F.col("_t"))),
    }
    verdict = F.lit(None).cast("string")
    for r in reversed(order):
        verdict = F.when(known.get(r.name, r.fails(F.col("_t"))), F.lit(r.name)).otherwise(verdict)
    return m.withColumn("rejected_by", verdict).drop("_t")
