"""Chunk-with-halo execution of row-positional windows.

A positional window (lag n, rolling n rows, lead n) needs a per-series row
order but not a single task per series. Plan:

1. ``positions``: global 1-based row number per series without a
   series-wide sort. Rows are bucketed by time (``bucket_seconds``); bucket
   sizes are counted (small table), prefix-summed per series, and joined
   back (AQE broadcasts it when its measured size allows, else sort-merge);
   ``rn = row_number() within (series, bucket) + offset``.
2. ``chunk = (rn-1) div C``; a row is also copied into the next chunk when it
   is among the last ``lookback`` rows of its chunk, and into the previous
   chunk when among the first ``lookahead`` rows (C >= both, so only
   neighbours are involved).
3. Windows run over ``partitionBy(series, chunk).orderBy(rn)``; only the
   owned copy of each row is kept.

A series that holds a third of all rows is therefore spread over
``rows / C`` tasks instead of one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.schema import SERIES, TS

RN = "_rn"
CHUNK = "_chunk"
OWN = "_own"
BUCKET = "_bucket"

DEFAULT_BUCKET_SECONDS = 7 * 86400
DEFAULT_CHUNK_ROWS = 4096


@dataclass(frozen=True)
class Halo:
    """Chunk-with-halo execution: tasks of bounded size whatever the series sizes."""

    chunk_rows: int | None = None
    bucket_seconds: int | None = None


# Strategy used when a positional operator is called without one:
#   "plain" -- one task per series (fewest exchanges). The hourly tables hold one row per
#              (series, hour), so a series grows by at most 8,784 rows a year whatever the
#              volume of events behind it: the calendar bounds the task, not the data;
#   "halo" or a ``Halo`` -- for frames without that promise (finer stamps, repeated stamps).
# Nothing is measured: the choice is the caller's, so building a plan starts no job.
DEFAULT_STRATEGY = "plain"


def resolve_strategy(strategy: str | Halo | None) -> Halo | None:
    """The ``Halo`` to run under, or None for the plain plan."""
    strategy = DEFAULT_STRATEGY if strategy is None else strategy
    if isinstance(strategy, Halo):
        return strategy
    if strategy == "halo":
        return Halo()
    if strategy == "plain":
        return None
    raise ValueError(f"unknown strategy {strategy!r}")


def positions(df: DataFrame, series=SERIES, ts=TS, bucket_seconds: int | None = None,
              rn: str = RN, bucket=None) -> DataFrame:
    """Add the 1-based position of each row within its series ordered by ``ts``
    (any orderable column). ``bucket`` must be monotone in ``ts``; by default
    fixed-width time buckets of ``bucket_seconds``."""
    keys = [series] if isinstance(series, str) else list(series)
    bucket_seconds = bucket_seconds or DEFAULT_BUCKET_SECONDS
    b = bucket if bucket is not None else F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / F.lit(bucket_seconds))
    staged = df.withColumn(BUCKET, b)
    ranked = staged.withColumn("_rb", F.row_number().over(Window.partitionBy(*keys, BUCKET).orderBy(ts)))
    # bucket sizes from the ranked branch itself: both uses share one exchange
    # (ReusedExchange), so the input is computed once
    counts = ranked.groupBy(*keys, BUCKET).agg(F.max("_rb").alias("_n"))
    offsets = counts.select(
        *keys, BUCKET,
        F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy(BUCKET)
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (ranked.join(offsets, [*keys, BUCKET])
            .withColumn(rn, (F.col("_rb") + F.col("_off")).cast("long"))
            .drop("_rb", "_off", BUCKET))


def with_halo(df: DataFrame, lookback: int, lookahead: int = 0, chunk_rows: int | None = None,
              rn: str = RN) -> DataFrame:
    """Assign chunks and replicate edge rows into the neighbouring chunks."""
    chunk_rows = chunk_rows or DEFAULT_CHUNK_ROWS
    if chunk_rows < max(lookback, lookahead, 1):
        raise ValueError("chunk_rows must cover the window reach")
    pos = F.col(rn) - 1
    chunk = F.floor(pos / F.lit(chunk_rows))
    within = pos - chunk * F.lit(chunk_rows)
    copies = F.array(
        F.struct(chunk.alias("c"), F.lit(True).alias("o")),
        F.when(within >= chunk_rows - lookback, F.struct((chunk + 1).alias("c"), F.lit(False).alias("o"))),
        F.when((within < lookahead) & (chunk > 0), F.struct((chunk - 1).alias("c"), F.lit(False).alias("o"))),
    )
    return (df.withColumn("_copies", F.filter(copies, lambda x: x.isNotNull()))
            .withColumn("_cp", F.explode("_copies"))
            .withColumn(CHUNK, F.col("_cp.c"))
            .withColumn(OWN, F.col("_cp.o"))
            .drop("_copies", "_cp"))


class PositionalPlan:
    """Window spec + finishing step for positional windows under a strategy.

    ``plain``: ``partitionBy(series).orderBy(ts)`` (one exchange, one task per
    series). ``halo``: chunk-with-halo (bounded task size for any series). A
    frame that already carries positions (``with_positions``) keeps them, so a
    pipeline of several operators assigns them once."""

    def __init__(self, df: DataFrame, series=SERIES, ts=TS, lookback: int = 24, lookahead: int = 0,
                 strategy: str | Halo | None = None):
        self.keys = [series] if isinstance(series, str) else list(series)
        self.ts = ts
        self.halo = resolve_strategy(strategy)
        if self.halo is None:
            self.df = df
            self.window = Window.partitionBy(*self.keys).orderBy(ts)
            return
        self.chunk_rows = self.halo.chunk_rows or DEFAULT_CHUNK_ROWS
        self.positioned = RN in df.columns
        staged = df if self.positioned else positions(df, self.keys, ts, self.halo.bucket_seconds)
        self.df = with_halo(staged, lookback, lookahead, self.chunk_rows)
        self.window = Window.partitionBy(*self.keys, CHUNK).orderBy(RN)

    def finish(self, df: DataFrame, keep_position: bool = False) -> DataFrame:
        if self.halo is None:
            return df
        out = df.filter(F.col(OWN)).drop(CHUNK, OWN)
        return out if keep_position or self.positioned else out.drop(RN)


def with_positions(df: DataFrame, series=SERIES, ts=TS, strategy: str | Halo | None = None) -> DataFrame:
    """``df`` with the positions that several operators of one pipeline share
    (unchanged under ``plain``); rows must not be dropped in between."""
    halo = resolve_strategy(strategy)
    return df if halo is None else positions(df, series, ts, halo.bucket_seconds)


def chunk_index(df: DataFrame, keys, ts, chunk_rows: int | None = None,
                bucket_seconds: int | None = None) -> DataFrame:
    """Positions plus a chunk id (no halo copies): the layout for unbounded
    frames computed chunk-locally and stitched with a per-chunk carry."""
    staged = positions(df, keys, ts, bucket_seconds)
    return staged.withColumn(CHUNK, F.floor((F.col(RN) - 1) / F.lit(chunk_rows or DEFAULT_CHUNK_ROWS)))


SUPER_CHUNKS = 4096  # chunks per second-level group of the carry computation


def carry_last(summary: DataFrame, keys, cols) -> DataFrame:
    """For each chunk: last non-NULL value of each column over all earlier chunks.

    Two levels, so no task sees more than ``SUPER_CHUNKS`` rows: a window inside
    each group of chunks, and a window over the one-row-per-group table."""
    sup = F.floor(F.col(CHUNK) / F.lit(SUPER_CHUNKS))
    s2 = summary.withColumn("_sup", sup)
    win = Window.partitionBy(*keys, "_sup").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inner = s2.select(*keys, CHUNK, "_sup", *[F.last(f"_end_{c}", ignorenulls=True).over(win).alias(f"_i_{c}")
                                              for c in cols])
    groups = s2.groupBy(*keys, "_sup").agg(*[F.max_by(F.col(f"_end_{c}"), F.when(F.col(f"_end_{c}").isNotNull(),
                                                                                 F.col(CHUNK))).alias(f"_g_{c}")
                                             for c in cols])
    wg = Window.partitionBy(*keys).orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1)
    outer = groups.select(*keys, "_sup", *[F.last(f"_g_{c}", ignorenulls=True).over(wg).alias(f"_o_{c}") for c in cols])
    j = inner.join(outer, [*keys, "_sup"], "left")
    return j.select(*keys, CHUNK, *[F.coalesce(F.col(f"_i_{c}"), F.col(f"_o_{c}")).alias(f"_in_{c}") for c in cols])


def carry_sum(summary: DataFrame, keys, cols) -> DataFrame:
    """For each chunk: sum of each column over all earlier chunks (two levels,
    as :func:`carry_last`)."""
    sup = F.floor(F.col(CHUNK) / F.lit(SUPER_CHUNKS))
    s2 = summary.withColumn("_sup", sup)
    win = Window.partitionBy(*keys, "_sup").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inner = s2.select(*keys, CHUNK, "_sup", *[F.coalesce(F.sum(f"_tot_{c}").over(win), F.lit(0)).alias(f"_i_{c}")
                                              for c in cols])
    groups = s2.groupBy(*keys, "_sup").agg(*[F.sum(f"_tot_{c}").alias(f"_g_{c}") for c in cols])
    wg = Window.partitionBy(*keys).orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1)
    outer = groups.select(*keys, "_sup", *[F.coalesce(F.sum(f"_g_{c}").over(wg), F.lit(0)).alias(f"_o_{c}")
                                           for c in cols])
    j = inner.join(outer, [*keys, "_sup"], "left")
    return j.select(*keys, CHUNK, *[(F.col(f"_i_{c}") + F.coalesce(F.col(f"_o_{c}"), F.lit(0))).alias(f"_in_{c}")
                                    for c in cols])
