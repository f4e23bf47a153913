"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, html_extract, langid, line_dedup, merkle, mixing, near_dup, packing, quality, topk, toxicity, warc, whitening
from .common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    records = pages.select(F.col("page_id").alias("record_id"), "url", F.encode("html", "UTF-8").alias("payload"))
    back = warc.parsed(warc.read_archive(spark, warc.write_archive(records)))
    return back.withColumnRenamed("record_id", "page_id")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(toxicity.fold_of(F.col("doc_id")) == 2, F.lit(False))
    model = langid.train(docs.filter(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs)[0].select("doc_id", "size", "source_size", "target", "taken")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), k=4)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality.measure(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = (F.col("n_words") < quality.MIN_WORDS) | (100 * F.col("n_repeat_words") > quality.MAX_REPEAT_PERCENT * F.col("n_words"))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & F.col("rejected_by").isNull()).alias("kept"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.pmod("id", F.lit(100)) == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    held_out = F.coalesce(toxicity.fold_of(F.col("doc_id")) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    out = merkle.prove(merkle.manifest(merkle.document_leaves(docs, tampered)), "claimed")
    return out.withColumnRenamed("id", "doc_id")


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    out = whitening.whiten(vectors, whitening.fit_whitening(vectors))
    # Null where the exact sum has no long; the decimal has it.
    return out.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_html_extraction": op2_html_extraction,
    "op3_language_id": op3_language_id,
    "op4_mixing": op4_mixing,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_dedup": op7_line_dedup,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_toxicity": op9_toxicity,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_embedding_whitening": op13_embedding_whitening,
}

# Fixed values of the word and key definitions: space and U+0009..U+000D.
_WS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

_OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
tri AS (SELECT doc_id, i, ws[i] || chr(1) || ws[i+1] || chr(1) || ws[i+2] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS p FROM rep) GROUP BY 1),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{_WS}', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS n_upper
      FROM w JOIN ln USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_upper > 40 * word_chars
       OR 100 * n_dup_lines > 50 * n_lines OR word_chars > 20 * n_words) AS kept
FROM b
"""

_KEY = (r"translate(regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),"
        " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_OP7 = f"""
WITH l AS (SELECT doc_id, i, ls[i] AS l FROM (
    SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
k AS (SELECT doc_id, i, l, {_KEY} AS k FROM l),
f AS (SELECT k, max(doc_id) AS keeper FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, i, l, f.k IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f ON k.k = f.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_OP8 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(list_zip(q.e, x.e), lambda t: t[1] * t[2]))::BIGINT AS score
      FROM v q, v x WHERE q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 10
"""

def _fields(*names: str) -> str:
    return " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || {c} END" for c in names)


_TREE = """SELECT level + 1, {key}pos >> 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(n) FROM {name}
    WHERE ((n - 1) >> (3 * level)) > 0 GROUP BY ALL"""
_SIDE = "coalesce(string_agg(h, '') OVER (PARTITION BY {key}level, pos >> 3 ORDER BY pos ROWS BETWEEN {rows}), '')"
_LEFT, _RIGHT = "UNBOUNDED PRECEDING AND 1 PRECEDING", "1 FOLLOWING AND UNBOUNDED FOLLOWING"
_OP11 = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t),
d AS (SELECT coalesce('=' || lang, '') AS g, doc_id, source, lang, n_chars, text,
  CASE WHEN xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claim
  FROM documents, crc),
hashed AS (SELECT g, doc_id, sha256({_fields('doc_id', 'source', 'lang', 'n_chars', 'text')}) AS h,
  sha256({_fields('doc_id', 'source', 'lang', 'n_chars', 'claim')}) AS claim FROM d),
leaf AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM hashed),
low AS (SELECT 0 AS level, g, pos, h, n FROM leaf UNION ALL {_TREE.format(key='g, ', name='low')}),
sub AS (SELECT g, arg_max(h, level) AS subroot, max(level) AS depth FROM low GROUP BY g),
top AS (SELECT 0 AS level, row_number() OVER (ORDER BY g) - 1 AS pos, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL {_TREE.format(key='', name='top')}),
place AS (SELECT g, subroot, depth, row_number() OVER (ORDER BY g) - 1 AS seat FROM sub),
root AS (SELECT arg_max(h, level) AS root, max(level) AS height FROM top),
side AS (SELECT level, g, pos, {_SIDE.format(key='g, ', rows=_LEFT)} AS l, {_SIDE.format(key='g, ', rows=_RIGHT)} AS r FROM low),
side2 AS (SELECT level, pos, {_SIDE.format(key='', rows=_LEFT)} AS l, {_SIDE.format(key='', rows=_RIGHT)} AS r FROM top),
step AS (
  SELECT leaf.g, leaf.pos, level AS step, l, r FROM leaf JOIN place USING (g) JOIN side
    ON side.g = leaf.g AND level < depth AND side.pos = leaf.pos >> (3 * level)
  UNION ALL SELECT leaf.g, leaf.pos, depth + level, l, r FROM leaf JOIN place USING (g), root, side2
    WHERE level < height AND side2.pos = seat >> (3 * level)),
fold AS (SELECT g, pos, 0 AS step, claim AS h FROM leaf
  UNION ALL SELECT f.g, f.pos, f.step + 1, sha256(l || f.h || r) FROM fold f JOIN step s ON f.g = s.g AND f.pos = s.pos AND f.step = s.step),
proof AS (SELECT g, pos, sha256(string_agg(l || r, '' ORDER BY step)) AS p FROM step GROUP BY g, pos)
SELECT doc_id, leaf.h AS leaf, subroot, root, coalesce(p, sha256('')) AS proof_sha256, fold.h AS folded_root, fold.h = root AS verified
FROM leaf JOIN place USING (g) JOIN fold ON fold.g = leaf.g AND fold.pos = leaf.pos LEFT JOIN proof ON proof.g = leaf.g AND proof.pos = leaf.pos, root
WHERE fold.step = depth + height
"""

ORACLES = {
    "op6_quality_rules": _OP6,
    "op7_line_dedup": _OP7,
    "op8_exact_top_k": _OP8,
    "op11_merkle_manifest": _OP11,
}
