"""Pages and quality: extraction, URL filters, WARC archives, quality rules, against plain versions."""

import hashlib
import html
import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.llm import extract, quality, queries, urls, warc
from tests.llm.test_scans import SMALL, docs_of, rows

PAGE = "page_id long, url string, html string"


def pages_of(spark, found):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(found)], PAGE)


# -- HTML ------------------------------------------------------------------

def plain_article(page):
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    if not body:
        return ""
    parts = re.split(r"<h1>|</h1>|<p>|</p>", re.sub(r"<[^>]*\Z|<(?!/?(?:p|h1)>)[^>]*>", " ", body[1]))
    lines = (" ".join(html.unescape(x).split()) for x in parts)
    return "\n".join(x for x in lines if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_articles_of_the_given_pages(spark, sf):
    expected = {r.page_id: plain_article(r.html) for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in rows(queries.op2_html_extraction(spark, f"/root/testdata/{sf}"))}
    assert {k: r["text"] for k, r in got.items()} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


LONG = "A sentence of the article, which goes on for a while, as sentences do. It has a second part; and a third."
PIECES = {
    "menu": '<ul class="menu"><li><a href="/">Home</a><li>About us</ul>',
    "header": "<header><h2>The site, which has a name</h2></header>",
    "sidebar": '<div id="sidebar"><p>Other stories. More, and more, of them.</p></div>',
    "notice": '<div class="cookie-notice"><p>We use cookies, as sites do. Do you agree?</p></div>',
    "advert": '<div class="ad-box"><p>Buy this now, please. It is cheap, and good!</p></div>',
    "form": "<form><p>Your name, please.</p><input value='x'><button>Send</button></form>",
    "script": "<script>if (a < b) { document.write('<p>no, no, no.</p>') }</script><style>p > a {}</style>",
    "comment": '<section class="comments"><h3>Comments</h3><p>I liked it, really, a lot. Did you? I did.</p></section>',
    "footer": "<footer><p>&copy; The site, all rights reserved.</p></footer>",
    "remark": "<!-- <p>A remark, not seen.</p> -->",
}


@pytest.mark.parametrize("container", ["<article>{}</article>", '<div class="content">{}</div>',
                                       '<main role="main"><div>{}</div></main>', '<div><div class="post-body">{}</div></div>'])
def test_what_is_left_out_and_what_stays(container):
    inner = (f"<h1>A  title &amp; more</h1>{PIECES['advert']}<p>{LONG}<p>Short.</p>{PIECES['script']}{PIECES['remark']}"
             f"<blockquote>Quoted, <b>boldly</b>,\n &eacute;t&#233; &lt;tag&gt;.</blockquote><ul><li>One, two.</li></ul>"
             f"<p>{LONG} And <a href='x>y'>a link</a>.</p>{PIECES['form']}")
    page = ("<!DOCTYPE html><html><head><title>T</title></head><body>" + PIECES["menu"] + PIECES["header"]
            + PIECES["notice"] + container.format(inner) + PIECES["sidebar"] + PIECES["comment"] + PIECES["footer"])
    assert extract.main_text(page).split("\n") == [
        "A title & more", LONG, "Short.", "Quoted, boldly, été <tag>.", "One, two.", LONG + " And a link."]


def test_names_are_judged_word_by_word():
    page = (f'<body class="no-sidebar"><div class="header">Site, name.</div><div class="content has-comments"><p>{LONG}</p>'
            f'<div class="sideBar"><p>{LONG}</p></div><div class="loadable"><p>Kept, too.</p></div></div>'
            f'<div id="commentList"><p>{LONG}</p></div></body>')
    assert extract.main_text(page) == f"{LONG}\nKept, too."


@pytest.mark.parametrize("piece", [
    "<script>for(i=0;i<n;i++){f(i)}</script>", "<script>s='<!--'; t=\"it's\"</script>", "<SCRIPT>a<b</Script >",
    "<style>a:after{content:'<b'}</style>", "<textarea>x<y \"</textarea>", "<noscript><img alt='</noscript>",
    "<script>x = '<\\/script>' + '</scripts' + \"<p\"</script\n>", "<iframe><!-- <a</iframe>"])
def test_markup_inside_verbatim_elements_is_not_read(piece):
    page = (f"<html><head><title>If a<b then \"c</title>{piece}</head><body><div><p>{LONG}</p>{piece}<p>{LONG}</p>"
            f"<script>let last = 1</script><p>After{piece}wards, too.</p></div></body></html>")
    assert extract.main_text(page) == f"{LONG}\n{LONG}\nAfterwards, too."
    assert extract.main_text(f"<p>{LONG}</p><script>if (a<b) {{ cut off") == LONG


@pytest.mark.parametrize("tag, attributes", [
    ("div", 'style="overflow: hidden"'), ("div", "title='a hidden gem'"), ("div", 'data-x="1" alt=" hidden id=ads "'),
    ("article", 'class="post category-announcements"'), ("div", 'class="content-sidebar-wrap"'),
    ("div", 'id=page class="layout-right-sidebar"'), ("div", 'class="header-and-content"'), ("section", 'class="notice"')])
def test_a_word_does_not_take_out_the_article(tag, attributes):
    inside = f"<h1>A title</h1><p>{LONG}</p>{PIECES['sidebar']}<p>It is <math><mi>x</mi><mo>=</mo><mn>2</mn></math>, so.</p><p>{LONG}"
    page = f"<body>{PIECES['menu']}{PIECES['header']}<{tag} {attributes}>{inside}</{tag}>{PIECES['comment']}{PIECES['footer']}"
    assert extract.main_text(page) == f"A title\n{LONG}\nIt is x=2, so.\n{LONG}"


def test_hidden_and_named_parts_still_go():
    for attributes in ("hidden", 'HIDDEN=""', "class=x hidden", 'title="a" hidden=until-found', 'class="x ad-box"', "id='comments'"):
        for tag in ("div", "span"):
            page = f"<article><p>{LONG}</p><p>Be<{tag} {attributes}>{LONG[:40]}</{tag}></p><p>{LONG}</p></article>"
            assert extract.main_text(page) == f"{LONG}\nBe\n{LONG}", (tag, attributes)


@pytest.mark.parametrize("body, lines", [
    ("<div class=post><h1>A title</h1><div class=lead><p>{0}</p></div><div class=entry>{1}</div></div>", ["A title", LONG, *[LONG] * 12]),
    ("<div><div><h2>One</h2>{1}</div><div><h2>Two</h2><p>{0}</p><p>So.</p></div></div>", ["One", *[LONG] * 12, "Two", LONG, "So."]),
    ("<article><section>{1}</section><section><p>{0}</p></section></article>", [*[LONG] * 12, LONG]),
    ("<main><article>{1}</article><section><h3>Two</h3><p>{0}</p></section></main>", [*[LONG] * 12, "Two", LONG]),
    ("<article>{1}</article><article><p>{0}</p></article>", [*[LONG] * 12, LONG]),
    ("<div><h1>A title</h1><div>By X</div><div class=entry>{1}</div></div>", ["A title", "By X", *[LONG] * 12]),
    ("<div><div>{1}</div><div>" + "<li><a href=x>More</a>" * 12 + "</div></div>", [LONG] * 12),
    ("<article>{1}</article><div><p>{0}</p></div>", [LONG] * 12)])
def test_no_part_of_the_article_is_lost(body, lines):
    page = f"<body>{PIECES['menu']}{PIECES['header']}{body}{PIECES['sidebar']}{PIECES['comment']}{PIECES['footer']}"
    assert extract.main_text(page.format(LONG, f"<p>{LONG}</p>" * 12)).split("\n") == lines


def test_extraction_of_odd_pages(spark):
    found = [("u", None), (None, ""), ("u", "no tags, only text"), ("u", "<p>a<p>b</div></b>"), ("u", "<article><p>cut &am"),
             ("u", "<article><p>cut <a hre"), ("u", "<p>" + "x y. " * 50_000), ("u", "<div>" * 3000 + "deep"), ("u", "<p>a<p>b</div></b>")]
    docs = pages_of(spark, found).withColumn("text", F.lit("clash"))
    got = [r["text"] for r in rows(extract.extract(docs).orderBy("page_id"))]
    assert got == ["", "", "no tags, only text", "a\nb", "cut &am", "cut", ("x y. " * 50_000).strip(), "deep", "a\nb"]
    assert extract.extract(pages_of(spark, [])).count() == 0


# -- URL filters -----------------------------------------------------------

URLS = [None, "", "example.org/es/", "http://", "HTTP://Www.EXAMPLE.org/es/x?y", "http://example.org/en/12#x",
        "http://example.org/EN/12", "http://badexample.org/es/", "https://a.com/de/", "https://com/de", "x://y.com?/de/",
        "http://É.com/fr/", "http://org", "http://.org/", "ftp://a.b.example.org/en/1/2", "http://a.com/de/?q", "://org/",
        "http://" + "a." * 20_000 + "org/" + "x" * 50_000, "http://a.com/de/?q"]


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_against_all_rules(spark, tmp_path):
    given = [r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    pages_of(spark, [(u, "") for u in [*URLS, *given]]).withColumn("host", F.lit("clash")).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in rows(queries.op4_url_filter(spark, str(tmp_path)))}
    assert len(got) == len(URLS) + len(given)
    for i, url in enumerate([*URLS, *given]):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == plain_verdict(url, urls.RULES), url


def test_many_rules_and_a_cascade_of_several_levels(spark):
    rules = [(("allow", "block")[i % 2], f"h{i}.net", "/" * (i % 3 > 0) + "p" * (i % 3 > 1)) for i in range(40)]
    found = [(f"http://w.h{i}.net/{'p' * (i % 5)}{i}", "") for i in range(3000)]
    got = rows(urls.judge(pages_of(spark, found), rules=rules))
    assert len(got) == 3000
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(found[r["page_id"]][0], rules)
    assert {r["verdict"] for r in rows(urls.judge(pages_of(spark, found[:3]), rules=()))} == {"allow"}
    assert urls.judge(pages_of(spark, [])).count() == 0


def test_very_many_rules_of_many_shapes(spark):
    """100,000 rules of over sixteen shapes, far more than there are URLs: judged by the same expressions."""
    rules = [(("allow", "block")[i % 2], ("a.b." * (i % 4)) + f"h{i}.net", "/" + "p" * (i % 9)) for i in range(100_000)]
    assert len(urls._shapes(rules)) > urls.UNROLLED
    rng = random.Random(4)
    found = []
    for _ in range(1500):
        _, host, path = rng.choice(rules)
        found.append((f"http://{rng.choice(['', 'w.', 'x.y.'])}{host}{rng.choice([path, path + 'q', path[:-1], ''])}", ""))
    by_host = {}
    for rule in rules:
        by_host.setdefault(rule[1].rsplit(".", 2)[-2], []).append(rule)
    got = rows(urls.judge(pages_of(spark, [*found, found[0], (None, "")]), rules=rules))
    assert len(got) == 1502
    for r in got:
        url = [*found, found[0], (None, "")][r["page_id"]][0]
        near = by_host.get(re.search(r"(h[0-9]+)\.net", url)[1], []) if url else []
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(url, near)


def test_a_cascade_is_exact_for_its_universe(spark):
    universe = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("key % 7 = 0")
    cascade = urls.Cascade(listed, universe, 715, 5000)
    assert len(cascade.levels) > 2
    wrong = universe.where(cascade.has(F.col("key")) != (F.col("key") % 7 == 0))
    assert wrong.count() == 0


# -- WARC ------------------------------------------------------------------

def plain_warc(found):
    best = {}
    for i, (_, page) in enumerate(found):
        data = (page or "").encode()
        if len(data) >= 1000:
            best[data] = i
    out = {}
    for i, (_, page) in enumerate(found):
        data = (page or "").encode()
        other = best.get(data, i)
        out[i] = (len(data), hashlib.sha1(data).hexdigest(), "response" if other == i else "revisit",
                  None if other == i else other)
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_archives_come_back(spark, tmp_path, version):
    big = "é\r\n\r\nWARC/1.1\r\n" * 100
    found = [("http://a/ b\n", big), (None, big), ("", None), ("http://x/é", "x" * 999), ("u", "x" * 999), ("u", big),
             ("u", "y" * 1000), ("u", "y" * 1000), ("u", ""), ("u", "z" * 300_000)] + [("v", "w" * 1200)] * 50
    pages = pages_of(spark, found).withColumn("payload_bytes", F.lit(1))
    got = rows(warc.round_trip(pages, version, archive_bytes=20_000))
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got} == plain_warc(found)
    assert len({r["record_id"] for r in got}) == len(found) == len(got)
    assert {r["date"] for r in got} == {"2024-01-02T03:04:05Z"}
    uris = {r["page_id"]: r["uri"] for r in got}
    assert uris[1] == "-" and uris[5] == "u" and " " not in uris[0] and "\n" not in uris[0]


def test_archives_of_null_ids_repeated_rows_and_no_rows(spark):
    page = "q" * 2000
    pages = spark.createDataFrame([(None, "u", page), (3, "u", page), (3, "u", page), (None, "u", None)], PAGE)
    got = rows(warc.round_trip(pages))
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got) == Counter(
        [(None, "revisit", 3), (3, "response", None), (3, "revisit", 3), (None, "response", None)])
    assert warc.round_trip(pages_of(spark, [])).count() == 0


def test_header_lines_follow_their_version():
    v1 = b"filedesc://x 0.0.0.0 2024 text/plain 65\n1 0 org\nURL IP-address Archive-date Content-type Archive-length\n"
    body = v1.split(b"\n", 1)[1]
    v1 = v1.replace(b" 65\n", b" %d\n" % len(body)) + b"\nhttp://a 1.2.3.4 20200101000000 text/html 5\na\nb\nc\n"
    (_, fields, content), = warc.arc_records(v1)
    assert content == b"a\nb\nc" and fields["IP-address"] == "1.2.3.4"
    with pytest.raises(ValueError, match="declares"):
        list(warc.arc_records(v1[:-4]))
    with pytest.raises(ValueError, match="fields"):
        list(warc.arc_records(v1.replace(b"text/html 5", b"text/html x 5")))


def test_given_pages_come_back(spark):
    found = [(r.url, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").collect()]
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in rows(queries.op7_warc(spark, SMALL))}
    assert got == plain_warc(found)


# -- quality ---------------------------------------------------------------

def plain_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed)


def test_measures_against_a_plain_version(spark, tmp_path):
    small = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    odd = [None, "", " \t\x0b\x0c\r\n", "a b c d e a b c d e", "a a a a a a a a a a a", "é\u00a0x \u2003 y", "x\n\nx\n x\n \n", "a\x1cb c",
           "1 2 3 4 5 6 1 2 3 4 5 9 9 1 2 3 4 5", "w " * 30_000, "one two three four five six seven eight nine ten #"]
    texts = [*small, *odd, odd[3]]
    docs_of(spark, texts).withColumn("n_words", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in rows(queries.op9_quality(spark, str(tmp_path)))}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(got[i][c] for c in names) == plain_measures(text), text
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_thresholds_keep_good_texts_and_refuse_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r["doc_id"]: r["kept"] for r in rows(queries.op9_quality(spark, sf))}
    short = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len((r.text or "").split()) < 10}
    good = [got[d] for d, q in labels.items() if q == 1 and d not in short]
    bad = [got[d] for d, q in labels.items() if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def plain_kept(found):
    """Verdicts from thresholds by language and source, worked out text by text in whole numbers."""
    measured = {}
    for i, text, lang, source in found:
        n_words, chars, symbols, dup_lines, _, failed = plain_measures(text)
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        upper = sum(unicodedata.category(c) == "Lu" for c in text or "")
        measured[i] = (lang, source, failed, {"symbols": (symbols, chars, 10_000), "capitals": (upper, chars, 10_000),
                                              "repeated_lines": (dup_lines, len(lines), 10_000), "word_length": (chars, n_words, 100)})

    def quartiles(name, match):
        steps = sorted(c * r // o for lang, source, failed, of in measured.values() if not failed and match(lang, source)
                       for c, o, r in [of[name]])
        at = [steps[-(-k * len(steps) // 4) - 1] for k in (1, 2, 3)]
        return len(steps), at[1], at[2] - at[0]

    def limit(name, lang, source):
        levels = [quartiles(name, lambda a, b: (a, b) == (lang, source)), quartiles(name, lambda a, b: a == lang),
                  quartiles(name, lambda a, b: True)]
        use = next(x for k, x in enumerate(levels) if k == 2 or x[0] >= 30)
        return use[1] + 4 * use[2]

    limits, kept = {}, {}
    for i, (lang, source, failed, of) in measured.items():
        kept[i] = not failed
        for name, (count, size, resolution) in of.items() if not failed else ():
            key = name, lang, source
            limits[key] = limits[key] if key in limits else limit(*key)
            allowed = (limits[key] + 1) * size / resolution
            kept[i] &= count <= allowed + 4 * math.sqrt(max(1, allowed))
    return kept


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_verdicts_against_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 > 0, F.col("source")))
    expected = plain_kept([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
    for n in (1, 7):
        got = {r["row"]["doc_id"]: r["kept"] for r in rows(quality.judged(docs.repartition(n)))}
        assert got == expected
    assert {r["doc_id"] for r in rows(quality.keep(docs))} == {i for i, k in expected.items() if k}


def test_thresholds_adapt_to_their_group(spark):
    plain = "word number one and then some more words of a text that is long enough to judge"
    rich = plain.replace(" ", " # ", 9)
    texts = [(i, rich if s == "code" else plain, None, s, 0) for i, s in enumerate(["code"] * 30 + [None] * 30)]
    # a source whose texts vary widely has a wider threshold than one without any spread
    texts += [(100 + i, plain.replace(" ", " # ", i % 16), None, "code", 0) for i in range(60)]
    texts.append((999, rich, None, None, 0))
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["row"]["doc_id"]: r["kept"] for r in rows(quality.judged(docs, keep_cols=("doc_id",)))}
    assert all(v for k, v in got.items() if k != 999) and not got[999]
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.count() == len(texts) - 1
    assert quality.keep(docs.where("false")).count() == 0
