"""Archive, extraction and exact search."""

import base64
import hashlib
import heapq
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.llm import html_extract, topk, warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def records(df):
    return df.select(F.col("page_id").alias("record_id"), "url", F.encode("html", "UTF-8").alias("payload"))


@pytest.mark.parametrize("rows", [
    [(1, "http://a/x", "<p>é</p>", "d"), (2, "http://a/y", "<p>é</p>", "d"), (3, None, None, None), (4, "http://a/\r\nz", "", "d"),
     (5, "http://b", "long " * 200_000, "d"), (7, "http://c", "own", None)],
    [(1, "u", "same", "d"), (1, "u", "same", "d"), (0, "v", "same", "d"), (None, "w", "same", "d"), (None, "w", "lone", "d"), (None, None, None, None)],
    [],
])
def test_archive_round_trip(spark, rows):
    path = warc.write_archive(records(pages(spark, rows)))
    store = spark.read.parquet(f"{path}/payloads")
    assert store.count() == store.select("digest").distinct().count() == len({r[2] or "" for r in rows})
    got = warc.read_archive(spark, path)
    back = {(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.parsed(got).collect()}
    want = set()
    for i, _, h, _ in rows:
        b = (h or "").encode()
        top = max((r[0] for r in rows if (r[2] or "") == (h or "") and r[0] is not None), default=None)
        kind = "response" if i == top else "revisit"
        want.add((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), kind, None if i == top else top))
    assert back == want and got.count() == len(rows)
    for r in got.collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: ")][0][16:])
        assert rest[length:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_small_payloads_are_not_revisits(spark):
    path = warc.write_archive(records(pages(spark, [(1, "u", "ab", ""), (2, "u", "ab", "")])), min_bytes=3)
    assert {r.record_type for r in warc.parsed(warc.read_archive(spark, path)).collect()} == {"response"}


def test_changed_payload_is_found(spark, tmp_path):
    path = warc.write_archive(records(pages(spark, [(1, "u", "ab", "")])), f"{tmp_path}/a")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"xx")).write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, f"{tmp_path}/b").collect()


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>if(a<b)document.write("<p>no</p>")</script></head>
<body><header><a href=/>Home</a></header><nav><ul><li>Menu<li>More</ul></nav><div class="cookie-notice">We use cookies</div>
<div class='ad box'>Buy</div><main><article><header><h1>A &amp; B</h1></header><p>One  <b>two</b>
three<br>four<p>f&eacute;&#x41;<form><input>no</form><aside>no</aside><!-- <p>no</p> --><script>"</p>"</script>
<ul><li>x<li>y</ul></article><section id="comments"><p>reader</p></section></main><div class="sidebar">no</div>
<footer>&copy; no</footer></body></html>"""


def test_lines_of_article():
    lines = html_extract.lines_of(PAGE)
    assert [t for r, t in lines if r == html_extract.MAIN] == ["A & B", "One two three", "four", "féA", "x", "y"]
    assert html_extract.lines_of(None) == [] and html_extract.lines_of("plain &lt; text") == [(html_extract.PLAIN, "plain < text")]
    assert [t for _, t in html_extract.lines_of("<nav><a>m</a><article><p>t</p></article>") if _ == html_extract.MAIN] == ["t"]


def test_differencing_deletes_what_neighbours_share(spark, empty):
    def plain(body):
        return f"<html><body><p>Site name</p><div><p>{body}</p><p>second of {body}</p></div><p>All rights</p></body></html>"

    rows = [(i, f"http://h.example/{'ab'[i % 2]}/{i}", plain(f"story {i}"), "") for i in range(12)]
    rows += [(50, "http://alone.example/x", plain("lone"), ""), (51, None, plain("nowhere"), ""), (None, "http://h.example/q", plain("no id"), ""),
             (52, "http://h.example/e", None, ""), (53, "http://copy.example/1", plain("same"), ""), (54, "http://copy.example/2", plain("same"), ""),
             (55, "http://g.example/1", PAGE, ""), (55, "http://g.example/1", PAGE, ""), (56, "http://g.example/2", PAGE.replace("four", "5"), "")]
    got = {(r.page_id, r.text) for r in html_extract.extract(pages(spark, rows).repartition(3)).collect()}
    text = dict(got)
    for i in range(12):
        assert text[i] == f"story {i}\nsecond of story {i}"
    assert text[50].startswith("Site name") and text[51].startswith("Site name") and text[None].startswith("Site name")
    assert text[52] == "" and text[53] == text[54] == "Site name\nsame\nsecond of same\nAll rights"
    assert text[55] == "A & B\nOne two three\nfour\nféA\nx\ny" and "5" in text[56].split("\n")
    assert html_extract.extract(pages(spark, [])).count() == 0


def test_copies_are_judged_on_unnamed_lines_and_paired_with_other_content(spark):
    def page(*plain):
        menu = "".join(f"<li>entry {i}" for i in range(100))
        return f"<html><body><nav><ul>{menu}</ul></nav><p>Site name</p>" + "".join(f"<p>{x}</p>" for x in plain) + "<p>All rights</p></body></html>"

    rows = [(1, "http://h.example/1", page("one", "uno", "un"), ""), (2, "http://h.example/2", page("two", "dos", "deux"), "")]
    rows += [(10 + i, f"http://c.example/a/{i}", page("same", "text"), "") for i in range(5)] + [(20, "http://c.example/b", page("other"), "")]
    text = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows).repartition(3)).collect()}
    assert text[1] == "one\nuno\nun" and text[2] == "two\ndos\ndeux" and text[20] == "other"
    assert {text[10 + i] for i in range(5)} == {"same\ntext"}


def test_every_row_gives_one_row(spark):
    def page(body):
        return f"<p>Site name</p><p>{body}</p><p>more {body}</p><p>All rights</p>"

    rows = [(1, "http://h.example/1", page("one"), "")] * 5 + [(1, "http://h.example/1", page("uno"), "")] * 2
    rows += [(2, "http://h.example/2", page("two"), ""), (1, "http://alone.example/", page("one"), "")]
    got = sorted((r.page_id, r.text) for r in html_extract.extract(pages(spark, rows).repartition(3)).collect())
    assert got == sorted([(1, "one\nmore one")] * 5 + [(1, "uno\nmore uno")] * 2 + [(2, "two\nmore two"), (1, "Site name\none\nmore one\nAll rights")])


def test_common_subsequence_against_brute_force():
    from functools import lru_cache
    rng = np.random.default_rng(4)
    for _ in range(100):
        a, b = rng.integers(0, 5, rng.integers(0, 12)).tolist(), rng.integers(0, 5, rng.integers(0, 12)).tolist()

        @lru_cache(None)
        def best(i, j):
            if i == len(a) or j == len(b):
                return 0
            return max(best(i + 1, j), best(i, j + 1), 1 + best(i + 1, j + 1) if a[i] == b[j] else 0)

        got = html_extract.common_subsequence(a, b)
        it = iter(b)
        assert len(got) == best(0, 0) and got == sorted(set(got)) and all(a[i] in it for i in got)


def brute_top(rows, k, asked):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(1024 * x) for x in v]
    out = []
    for q in good:
        if asked(q):
            c = [(-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(heapq.nsmallest(k, c), 1)]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).astype(np.float32).astype(float).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]  # a hot vector
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 4), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, [0.1] * 6),
             (2100, [1.0, 2.0]), (2200, [2.0, 1.0]), (2300, []), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", F.lit("clash")).repartition(3)
    want = brute_top(rows, 10, lambda q: q % 100 == 0)
    for block in (100, 8192):
        monkeypatch.setattr(topk, "DATA_BLOCK", block)
        monkeypatch.setattr(topk, "QUERY_BLOCK", max(4, block // 100))
        got = topk.top_k(df, F.pmod("id", F.lit(100)) == 0)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(3000, 8)) + 30 * rng.normal(size=(30, 8)).repeat(100, 0)).round().astype(np.int64) * 100
    ids = np.arange(3000)
    got, score = topk.search(ids[:40], x[:40], ids, x, 5, np.full(40, -np.inf))
    s = x[:40] @ x.T
    np.fill_diagonal(s, np.iinfo(np.int64).min)
    for r in range(40):
        order = np.lexsort((ids, ~s[r]))[:5]
        assert got[r].tolist() == order.tolist() and score[r].tolist() == s[r][order].tolist()


def test_archive_fields_come_from_the_record(spark):
    """Header names inside URLs, payloads and HTTP headers are no header lines."""
    fake = "WARC-Refers-To: <urn:x-record:7>"
    rows = [(1, f"http://a/?q={fake}", "p", "d"), (2, f"http://a/\r\n{fake}\r\nx", f"\r\n\r\nWARC/1.1\r\n{fake}\r\n", "d"),
            (3, f"\r\n{fake}\r\n", "WARC-Type: revisit\r\n", "d"), (9, f"http://b?{fake}", "p", "d"), (4, fake, "é\r\n\r\n", "d")]
    back = warc.read_archive(spark, warc.write_archive(records(pages(spark, rows))))
    got = {r.record_id: r for r in warc.parsed(back).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 9), 2: ("response", None), 3: ("response", None), 4: ("response", None), 9: ("response", None)}
    for i, _, h, _ in rows:
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode())
    # The record's own bytes are parsed: cut short, they give other fields.
    short = warc.parsed(back.withColumn("record", F.expr("substring(record, 1, octet_length(record) - 5)"))).filter("record_id = 9").first()
    assert short.payload_bytes == 0
    plan = warc.parsed(back)._jdf.queryExecution().optimizedPlan().toString()
    assert "header" in plan and "ISO-8859-1" in plan


@pytest.mark.parametrize("page,want", [
    ("<script>var s = '<!--';</script><article><p>Body text</p></article>", "Body text"),
    ("<script>document.write(\"<div class='x\");</script><article><p>It's fine</p></article>", "It's fine"),
    ("<article><div class='post-header'><h1>Title</h1></div><p class='share-price'>1</p><section id='related-work'>w</section>"
     "<div class='related-posts'>x</div></article>", "Title\n1\nw"),
    ("<div class='wrap has-sidebar'><p>Body</p><div class='sidebar'>no</div></div>", "Body"),
    ("<svg><p>a</p><article>b</article>", "b"), ("a <b class=it's>bold</b> x &gt; y < z", "a bold x > y < z"),
    ("<p>one<![CDATA[two]]>three</p>", "onetwothree"), ("<textarea>x", ""), ("<p>a</p><!-- <p>b</p>", "a"), ("<p title='a>b'>c</p>", "c"),
])
def test_ordinary_markup(spark, page, want):
    got = html_extract.extract(pages(spark, [(1, "http://h/x", page, "d")])).first()
    assert got.text == want


def test_very_long_pages_take_linear_time():
    """Unclosed tags, quotes, comments and raw elements; tens of thousands of equal lines."""
    began = time.perf_counter()
    for page in ("<a " * 80_000, '<a "' * 60_000 + ">", "<a '\" >" * 40_000, "<!--" * 60_000, "<svg>" * 50_000, "<script>" * 50_000, "<p>x</p>" * 30_000):
        html_extract.lines_of(page)
    for a, b in (([1] * 50_000, [1] * 49_990), ([1, 2] * 25_000, [2, 1, 1] * 16_000)):
        html_extract.common_subsequence(a, b)
    assert time.perf_counter() - began < 15


def test_common_subsequence_every_way_against_brute_force():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            now = [0]
            for j, y in enumerate(b):
                now.append(row[j] + 1 if x == y else max(row[j + 1], now[-1]))
            row = now
        return row[-1]

    rng = np.random.default_rng(4)
    for _ in range(400):
        a, b = (rng.integers(0, rng.choice([1, 2, 3, 12]), rng.integers(0, 25)).tolist() for _ in range(2))
        where = {}
        for j, x in enumerate(b):
            where.setdefault(x, []).append(j)
        for got in (html_extract.common_subsequence(a, b), html_extract.by_bits(a, where, len(b)), html_extract.by_pairs(a, where)):
            rest = iter(b)
            assert len(got) == length(a, b) and got == sorted(set(got)) and all(any(y == a[i] for y in rest) for i in got)
