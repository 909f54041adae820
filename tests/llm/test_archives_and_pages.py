"""WARC round trips and page extraction."""

import glob
import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from wardlens.llm import pages, warc
from wardlens.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, payload string, complete string"


def odd_pages(spark):
    long_page = "<html><body><article><p>" + " ".join(f"word{i}" for i in range(40_000)) + "</p></article></body></html>"
    same = "<p>" + "equal payload " * 20 + "</p>"
    rows = [
        (1, None, None), (2, "http://h/a", ""), (3, "http://h/b\nx", "short"), (4, "http://h/c", "short"),
        (9, "http://h/d", same), (5, "http://h/e", same), (7, "http://h/f", same), (5, "http://h/e", same),
        (None, "http://h/g", same), (None, None, "<p>" + "only without an id " * 9), (8, "http://h/h", long_page),
        (8, "http://h/h", long_page), (10, "http://h/i", "é漢\r\n\r\n0\r\n\r\n WARC/1.1\r\n" * 3000),
    ]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def test_round_trip_of_odd_pages(spark, tmp_path):
    table = odd_pages(spark)
    folder = str(tmp_path / "archives")
    warc.write_archives(table, folder, segment_bytes=1 << 12, chunk_bytes=1000, records_a_file=7)
    got = warc.read_archives(spark, folder).collect()
    assert len(got) == table.count() and all(r.complete for r in got)
    key = lambda r: (r.page_id is None, r.page_id or 0, r.payload_bytes)
    want = sorted(table.collect(), key=lambda r: (r.page_id is None, r.page_id or 0, len((r.html or "").encode())))
    for a, b in zip(sorted(got, key=key), want):
        html = (b.html or "").encode()
        revisit = html.startswith(b"<p>equal") and b.page_id != 5
        assert a.page_id == b.page_id and a.payload_bytes == len(html)
        assert a.record_type == ("revisit" if revisit else "response")
        assert a.refers_to == (5 if revisit else None)
        assert revisit or bytes(a.payload) == html
    kinds = set()
    for path in glob.glob(f"{folder}/*.gz"):
        with gzip.open(path) as archive:
            records = list(warc.parse_records(archive))
        assert len(records) <= 7
        kinds |= {f[b"warc-type"] for f, _ in records}
    assert kinds == {b"response", b"revisit", b"continuation"}


def test_a_lost_or_short_segment_is_not_complete(spark, tmp_path):
    records = list(warc.page_records(1, "http://h/a", b"x" * 5000, "0" * 64, None, 1000, 700))
    digest_of = __import__("hashlib").sha256(b"x" * 5000).hexdigest()
    good = list(warc.page_records(2, "http://h/b", b"x" * 5000, digest_of, None, 1000, 700))
    cases = {"lost": records[:2] + records[3:], "end": good[:-1], "good": list(reversed(good))}
    for name, kept in cases.items():
        folder = tmp_path / name
        folder.mkdir()
        with gzip.open(folder / "a.gz", "wb") as out:
            out.write(b"".join(r + warc.END for r in kept))
        rows = warc.read_archives(spark, str(folder)).collect()
        assert [r.complete for r in rows] == [name == "good"]
        assert (rows[0].payload is not None) == (name == "good")


def test_ids_of_any_type(spark, tmp_path):
    """Texts with spaces, percent signs and other alphabets, and dates, come back as they were."""
    page = "<p>" + "equal payload " * 20 + "</p>"
    rows = [("b c", page), ("é%20", page), ("", "x"), ("  a ", page), (None, page), ("line\r\nend", "y" * 9000)]
    texts = spark.createDataFrame(rows, "page_id string, html string").withColumn("url", F.lit("http://h/"))
    days = texts.withColumn("page_id", F.expr("date_add(DATE'2020-01-01', length(html) + coalesce(length(page_id), 50))"))
    for table, kind in ((texts, "string"), (days, "date")):
        folder = str(tmp_path / kind)
        warc.write_archives(table, folder, segment_bytes=1 << 12)
        found = warc.read_archives(spark, folder, kind)
        assert found.schema["page_id"].dataType.simpleString() == kind
        got = found.collect()
        want = {r.page_id for r in table.collect()}
        assert len(got) == 6 and all(r.complete for r in got) and {r.page_id for r in got} == want
        least = min(r.page_id for r in table.collect() if r.page_id is not None and r.html == page)
        assert {r.refers_to for r in got if r.record_type == "revisit"} == {least}
        assert sum(r.record_type == "revisit" for r in got) == 3


def test_repeated_rows_are_groups_of_their_own(spark, tmp_path):
    """Rows of one id and payload, NULL ids too, share no identifier; revisits name records that exist."""
    large = "<p>" + "long payload " * 2000 + "</p>"
    rows = [(1, large)] * 40 + [(None, large + "?")] * 20 + [(2, "<p>" + "once " * 900)] + [(3, "<p>" + "once " * 900)] * 3
    table = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit(None).cast("string"))
    folder = str(tmp_path / "copies")
    warc.write_archives(table.repartition(3), folder, segment_bytes=1 << 12)
    names, origins, referred = [], [], set()
    for path in glob.glob(f"{folder}/*.gz"):
        with gzip.open(path) as archive:
            for fields, _ in warc.parse_records(archive):
                names.append(fields[b"warc-record-id"])
                if b"warc-segment-origin-id" in fields:
                    origins.append(fields[b"warc-segment-origin-id"])
                if b"warc-refers-to" in fields:
                    referred.add(fields[b"warc-refers-to"])
    assert len(names) == len(set(names)) and set(origins) | referred <= set(names) and len(referred) == 1
    assert max(origins.count(o) for o in set(origins)) <= -(-len(large) * 2 // (1 << 12))
    got = warc.read_archives(spark, folder).collect()
    assert len(got) == 64 and all(r.complete for r in got)
    assert sum(r.record_type == "revisit" for r in got) == 3


def test_framing():
    draw = random.Random(2)
    for size in (0, 1, 999, 1000, 1001, 5000):
        payload = draw.randbytes(size)
        assert warc.unchunked(warc.chunked(payload, 1000)) == payload
    with pytest.raises(ValueError):
        warc.unchunked(warc.chunked(b"abcdef", 4)[:-8])
    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


def test_no_pages(spark, tmp_path):
    none = odd_pages(spark).limit(0)
    warc.write_archives(none, str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    assert pages.extract(none).count() == 0


def text_of(page):
    return "\n".join(pages.content_lines(pages.page_lines(page))[1])


def test_lines_of_an_article():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="page">
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><!-- <p>no</p> -->
      <div class="cookie-notice">We use <b>cookies</b><div>really</div></div><aside><p>Side</p></aside>
      <article><header><h1>Ti&amp;tle</h1></header><p>First&nbsp;<b>bold
      <i>text</b> here<br>and on.<p>Second &lt;tag&gt; &#233;t&eacute;.<div class="ad">Buy</div>
      <script>var t="</p><p>no";</script><form><p>Mail</p><input></form>
      <table><tr><td>a</td><td>b</td></tr></table><div class="comments"><p>Reader</p></div>
      <footer>Tags</footer></article><div id="sidebar"><p>More</p></div><footer>&copy; us</footer></body>"""
    assert text_of(page) == "Ti&tle\nFirst bold text here and on.\nSecond <tag> été.\na\nb"


def test_broken_markup():
    assert text_of("") == "" == text_of("<p>  </p><script>never closed <p>x")
    assert text_of("<div class=ad>Buy now<article><p>Kept</article>") == "Kept"
    assert text_of("a < b <p>c > d") == "a < b\nc > d"
    assert text_of("<main><p>In main</main><p>Out") == "In main"
    assert text_of("<p>one</div></p><p>two") == "one\ntwo"


def test_elements_without_an_end_hide_no_text():
    for empty in ('<svg width="1"/>', "<svg/>", "<iframe src='x' />", "<iframe src=http://a/></iframe>", "<canvas />"):
        assert text_of(f"<article><p>first</p>{empty}<p>second</p></article>") == "first\nsecond"
    assert text_of("<article><p>first</p><button>Share<p>second</p></article><p>out") == "first\nsecond"
    assert text_of("<div><button>Menu</div><article><p>first</p><button>Buy</button><p>second</p></article>") == "first\nsecond"
    assert text_of("<p>a <svg><svg><text>no</text></svg>no</svg> b <select><option>no</select>c") == "a b c"
    assert text_of("<p>a<noscript><p>no</p></noscript>") == "a"
    assert text_of("<title-page>kept</title-page>") == "kept"


def test_class_words_count_whole():
    part = lambda name: text_of(f'<article><p>text</p><div class="{name}"><p>part</p></div></article>')
    for name in ("ad-free story", "social-history", "alert-and-oriented", "load", "related-work"):
        assert part(name) == "text\npart", name
    for name in ("story ad", "ad-slot", "cookie-notice", "comments_list", "site-footer", "user-comments wide", "Advert"):
        assert part(name) == "text", name


def test_shared_lines_go_without_an_article(spark):
    page = lambda n: f"<body><p>Shop name</p><p>Text {n} of this page.</p><p>More of page {n}.</p><p>Call us</p></body>"
    rows = [(i, f"http://host.example/a/{i}", page(i)) for i in range(6)] + [
        (10, "http://other.example/x", page(10)), (11, None, None), (12, "http://host.example/a/7", page(5)),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in pages.extract(table).collect()}
    assert len(got) == 9 and got[11] == ""
    assert got[10] == "Shop name\nText 10 of this page.\nMore of page 10.\nCall us"
    cut = [got[i] == f"Text {i} of this page.\nMore of page {i}." for i in range(6)]
    assert all(cut) and got[12] == got[5]


def brute_texts(rows):
    """The differencing written page by page: contents of a host in a list, each beside its neighbours."""
    parsed = {r: pages.content_lines(pages.page_lines(r[2] or "")) for r in rows}
    hosts = {}
    for r in rows:
        url = (r[1] or "").lower()
        host, _, rest = url.partition("://")[2].partition("/") if "://" in url else ("", "", "")
        content, lines = parsed[r]
        path = f"/{rest}" if rest else ""
        if lines:
            seen = hosts.setdefault(host, {})
            same = (content, tuple(lines))
            seen[same] = min(seen.get(same, path), path)
        parsed[r] = (host, content, tuple(lines))
    texts = {}
    for host, seen in hosts.items():
        # Paths of different contents differ in these tables, so the order is settled by them.
        order = sorted(seen, key=lambda c: seen[c].encode())
        common = lambda a, b: len(os.path.commonprefix([seen[a], seen[b]]))
        for at, one in enumerate(order):
            near = [order[i] for i in (at - 1, at + 1) if 0 <= i < len(order)]
            lines = list(one[1])
            if near:
                other = max(near, key=lambda c: common(one, c))
                shared = pages.shared_lines(lines, other[1])
                pages_with = lambda x: sum(x in c[1] for c in order)
                often = lambda x: pages_with(x) >= 4 and 2 * pages_with(x) >= len(order)
                lines = [x for i, x in enumerate(lines) if not (i in shared and (not one[0] or often(x)))]
            texts[host, *one] = "\n".join(lines)
    return sorted((r[0], texts.get(parsed[r], "")) for r in rows)


@pytest.fixture(scope="module")
def site(spark):
    """Hosts with and without articles, notices inside articles, passages that two share, and copies."""
    draw = random.Random(5)
    rows = []
    for i in range(240):
        host = draw.choice(("a.example", "b.example", "c.example"))
        body = [f"Line {draw.randrange(400)} of the story." for _ in range(draw.randint(1, 6))]
        if host == "a.example":
            page = "".join(f"<p>{x}</p>" for x in ["Shop", *body, "Call us", f"Part {i % 3}"])
        else:
            notice = "Read our terms." if host == "b.example" or draw.random() < 0.2 else "Own words."
            page = "<p>Menu</p><article>" + "".join(f"<p>{x}</p>" for x in [*body, notice]) + "</article>"
        rows.append((i, f"http://{host}/{draw.choice('xyz')}/{draw.choice('pq')}{i:03d}", page))
    copies = [(1000 + i, f"{rows[7][1]}/copy{i:02d}", rows[7][2]) for i in range(40)]
    return rows + copies + [(2000, None, "<p>Shop"), (2001, None, None)]


def test_differencing_agrees_with_brute_force(spark, site):
    want = brute_texts(site)
    for parts in (1, 60):
        table = spark.createDataFrame(site, "page_id long, url string, html string").repartition(parts)
        assert sorted((r.page_id, r.text) for r in pages.extract(table).collect()) == want
    texts = dict(want)
    by_host = {h: [texts[i] for i, u, _ in site if u and f"//{h}/" in u] for h in ("a.example", "b.example")}
    assert not any("Shop" in t for t in by_host["a.example"])  # without an article
    assert sum("Read our terms." in t for t in by_host["b.example"]) == 0  # inside one, on the whole host
    assert len({texts[1000 + i] for i in range(40)} | {texts[7]}) == 1


def test_longest_common_subsequence():
    draw = random.Random(8)

    def brute(a, b):
        if not a or not b:
            return 0
        if a[0] == b[0]:
            return 1 + brute(a[1:], b[1:])
        return max(brute(a[1:], b), brute(a, b[1:]))

    long_ = [f"line {i % 700}" for i in range(5000)]
    assert len(pages.shared_lines(long_, long_[100:] + ["more"])) == 4900
    for _ in range(60):
        a, b = ([draw.choice("abcd") for _ in range(draw.randint(0, 8))] for _ in range(2))
        found = sorted(pages.shared_lines(a, b))
        assert len(found) == brute(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_text_of_all_pages(spark, folder, tables):
    """Every page of the table has one article; its blocks are cut out with regular expressions here."""
    import html as markup
    import re

    want = {}
    for r in tables("pages").collect():
        body = re.search(r"<article>(.*)</article>", r.html or "", re.S)
        lines = re.split(r"</?(?:p|h1)\b[^>]*>", body[1]) if body else []
        texts = (" ".join(markup.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in lines)
        want[r.page_id] = "\n".join(x for x in texts if x)
    rows = QUERIES["op9_page_differencing"](spark, folder).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_pages_with_odd_columns(spark):
    got = pages.extract(odd_pages(spark)).collect()
    assert len(got) == 13
    assert all(r.text == "" for r in got if r.page_id in (1, 2))
    assert all(r.n_chars > 200_000 for r in got if r.page_id == 8)
