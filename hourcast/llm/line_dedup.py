"""Line dedup (DataFrame functions only): explode normalised lines, hash, count
distinct documents per hash, drop lines over the threshold, reassemble by
position.

Only hashes, ids and positions of the lines long enough to count are shuffled
for the decision; the texts move once, to meet their own dropped positions.
A frequent line is counted with partial aggregation, and meets its decision
under ``SALTS`` keys in a join that adaptive execution can split further.

Defined results: a null or empty text is one empty line.  Rows with a null
``doc_id`` are returned unchanged and count for no line.  Rows that share a
``doc_id`` count as one document; equal rows get equal results.  Columns of the
input pass through unchanged except the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower

MIN_CHARS = 40
MIN_DOCS = 5
SALTS = 16


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept lines in ``text``, and ``n_lines`` (before) and
    ``n_dropped``.  A line whose key (stripped, A-Z lower-cased) has at least
    ``min_chars`` code points and is found in ``min_docs`` documents stays only
    in the largest ``doc_id`` that holds it."""
    body = F.coalesce(F.col(text), F.lit(""))
    row = F.xxhash64(F.col(doc_id), body)
    line = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("_d"), row.alias("_r"), F.posexplode(F.split(body, "\n")).alias("_p", "_l"))
    line = line.filter(F.char_length("_l") >= min_chars)
    line = line.select("_d", "_r", "_p", F.btrim("_l", F.lit(SPACES)).alias("_k"))
    line = line.filter(F.char_length("_k") >= min_chars).select("_d", "_r", "_p", ascii_lower(F.col("_k")).alias("_k"))
    line = line.select("_d", "_r", "_p", F.xxhash64("_k").alias("_h"), F.xxhash64(F.lit(7), "_k").alias("_g"))
    held = line.groupBy("_h", "_g", "_d").agg(F.lit(1).alias("_one"))
    often = held.groupBy("_h", "_g").agg(F.count("*").alias("_n"), F.max("_d").alias("_keep"))
    often = often.filter(F.col("_n") >= min_docs).drop("_n")
    # A frequent line's rows are salted by document over several keys.
    often = often.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    line = line.withColumn("_s", F.pmod("_r", F.lit(SALTS)).cast("int"))
    drop = line.join(often, ["_h", "_g", "_s"]).filter(F.col("_d") != F.col("_keep"))
    drop = drop.groupBy("_d", "_r").agg(F.collect_set("_p").alias("_drop"))
    n = len(docs.columns)
    src = docs.toDF(*[f"c{i}" for i in range(n)])
    c_text, c_id = f"c{docs.columns.index(text)}", f"c{docs.columns.index(doc_id)}"
    src = src.withColumn("_b", F.coalesce(F.col(c_text), F.lit("")))
    src = src.withColumn("_x", F.xxhash64(F.col(c_id), F.col("_b")))
    got = src.join(drop, (F.col(c_id) == F.col("_d")) & (F.col("_x") == F.col("_r")), "left")
    got = got.withColumn("_lines", F.split("_b", "\n"))
    # Positions that stay, in order; the array of lines is read by position.
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce("_drop", F.array().cast("array<int>")))
    got = got.withColumn("_stay", stay)
    kept = F.when(F.size("_stay") == F.size("_lines"), F.col("_b")).otherwise(
        F.array_join(F.transform("_stay", lambda i: F.col("_lines")[i]), "\n"))
    cols = [F.when(F.col("_drop").isNull(), F.col(c_text)).otherwise(kept).alias(text) if f"c{i}" == c_text
            else F.col(f"c{i}").alias(docs.columns[i]) for i in range(n)]
    return got.select(*cols, F.size("_lines").cast("long").alias("n_lines"),
                      (F.size("_lines") - F.size("_stay")).cast("long").alias("n_dropped"))
