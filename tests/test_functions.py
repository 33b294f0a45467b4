"""Golden cases of scalar functions, parsers and sources."""

import gzip
import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions import names as N
from siltstone.functions import urls as U
from siltstone.functions.annotate import baseline
from siltstone.operators import crawl as C
from siltstone.operators import entities as E
from siltstone.operators import search as S
from siltstone.operators import text as T
from siltstone.operators import web as P
from siltstone.sources import archives, files
from siltstone.streaming import ingest


def each(spark, column, rows):
    """The column over rows of strings u, v, in one job."""
    frame = spark.createDataFrame([(i, *r, *[None] * (2 - len(r))) for i, r in enumerate(rows)], "i int, u string, v string")
    return [r[1] for r in sorted(frame.select("i", column).collect())]


def one(spark, column, **values):
    frame = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return frame.select(column).first()[0]


@pytest.mark.parametrize(
    "name,short,want",
    [("Aktsiaselts Elrato OÜ", False, "oü elrato"), ("'Mari  Tamm'", False, "mari  tamm"), ('"AS Tere"', False, "as tere"), ("Jo An Kask", True, "kask"), ("ab", True, None), (None, False, None)],
)
def test_normalize(spark, name, short, want):
    frame = spark.createDataFrame([(name,)], "n string")
    assert frame.select(N.normalize_name(F.col("n"), drop_short=short)).first()[0] == want


def test_names(spark):
    assert one(spark, N.alternatives(F.col("n")), n="A|B C|D") == ["A C", "A D", "B C", "B D"]
    assert one(spark, N.name_keys(F.col("n")), n="Tere|Tere AS") == ["as tere"]
    assert one(spark, N.ngram_keys(F.col("n")), n="abcde") == ["abcd", "abcde", "bcde"]
    assert one(spark, N.without_subnames(F.array(F.lit("Tamm"), F.lit("Tamme Mari"), F.lit("A Tamm")))) == ["A TAMM", "TAMME MARI"]
    assert one(spark, N.birth_date(F.col("c")), c="38001011234") == "01.01.1980.".rstrip(".") and one(spark, N.birth_date(F.col("c")), c="123") is None
    assert one(spark, N.registry_date(F.col("d")), d="0000-00-00") is None


NORMAL = [
    ("\tHTTPS://Www.Tartu.EE ", "https://www.tartu.ee/"), ("http://ut.ee:80/a", "http://ut.ee/a"), ("http://ut.ee:8081/", "http://ut.ee:8081/"), ("ftp://ut.ee:21/x#y", "ftp://ut.ee/x"), ("http://ut.ee/d/e.html#part", "http://ut.ee/d/e.html"),
    ("http://ut.ee/d/e/../", "http://ut.ee/d/"), ("http://ut.ee/d/..", "http://ut.ee/d/.."), ("http://ut.ee/1/2/3/4/5/6/7/8/../../../../../../../../z", "http://ut.ee/z"), ("http://ut.ee/d/../../../z", "http://ut.ee/z"),
    ("http://ut.ee/../d/../e/../f/", "http://ut.ee/f/"), ("http://ut.ee/x..y/../z", "http://ut.ee/z"), ("http://ut.ee/d/..e", "http://ut.ee/d/..e"), ("http://ut.ee/a/./../b", "http://ut.ee/a/./../b"),
    ("http://ut.ee///d//e///f", "http://ut.ee/d/e/f"), ("https://ut.ee:443/?q=/../r", "https://ut.ee/?q=/../r"), ("no url", "no url"),
]


def test_url_normalize(spark):
    assert each(spark, U.normalize_basic(F.col("u")), NORMAL) == [want for _, want in NORMAL]


def test_url_substitutions(spark):
    pairs, id_ = [], "0a1B2c"
    for name in ("PHPSESSID", "phpsessid", "sid", "SID", "jsessionid", "Bv_SessionID", "BV_SESSIONID", "lsid"):
        pairs += [(f"http://ut.ee/a?{name}={id_}", "http://ut.ee/a"), (f"http://ut.ee/a?{name}={id_}&k=1", "http://ut.ee/a?k=1"), (f"http://ut.ee/a?k=1&{name}={id_}&m=2", "http://ut.ee/a?k=1&m=2")]
    pairs += [(f"http://ut.ee/a;jsessionid={id_}?k=1", "http://ut.ee/a?k=1"), (f"http://ut.ee/a;jsessionid={id_}#x", "http://ut.ee/a"), ("http://ut.ee/a#x?k=1", "http://ut.ee/a?k=1"), ("http://ut.ee/a?&k=1&&&m=2&", "http://ut.ee/a?k=1&m=2")]
    pairs += [(f"http://ut.ee/{page}", f"http://ut.ee/{page}") for page in ("main.html", "index.jsps", "index.jspfx", "index.png")]
    for pages in (False, True):
        assert each(spark, U.normalize_regex(F.col("u"), default_pages=pages), pairs) == [want for _, want in pairs]
    known = [f"http://ut.ee/d/{page}" for page in ("index.html", "Default.ASPX", "index.php4", "default.cgi", "index.jsp", "index.jsf", "index.jspx", "index.jspa", "index.xhtml", "index.cfm")]
    assert each(spark, U.normalize_regex(F.col("u"), default_pages=True), [(u,) for u in known] + [(u + "?k=1",) for u in known]) == ["http://ut.ee/d/"] * len(known) + ["http://ut.ee/d/?k=1"] * len(known)
    assert each(spark, U.normalize_regex(F.col("u")), [(u,) for u in known]) == known


DOMAINS = [
    ("http://a.b.ut.ee/x", "ut.ee", "ee"), ("http://ut.ee", "ut.ee", "ee"), ("http://10.20.30.40:80/x", "10.20.30.40", ""), ("http://www.bbc.co.uk:8080/", "bbc.co.uk", "co.uk"), ("http://co.uk/", "co.uk", "co.uk"), ("http://org", "org", "org"),
    ("http://www.co.uk.com/", "uk.com", "com"), ("http://x.y.com.tr.", "y.com.tr", "com.tr"), ("http://www.näide.商業.tw", "商業.tw", "tw"), ("http://a.b.parliament.uk", "b.parliament.uk", "parliament.uk"), ("nothing", "", ""),
]


def test_domains(spark):
    more, urls = ("parliament.uk",), [(u,) for u, _, _ in DOMAINS]
    assert each(spark, U.domain(F.col("u"), more), urls) == [d for _, d, _ in DOMAINS]
    assert each(spark, U.suffix(F.col("u"), more), urls) == [s for _, _, s in DOMAINS]


def test_resolution(spark):
    """The examples of RFC 3986, 5.4, and some more, against the library of Python."""
    from urllib.parse import urljoin

    page = "http://a/b/c/d;p?q"
    links = ("g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y", "g?y/./x", "g?y/../x", "g#s/../x")
    cases = [(page, x) for x in links] + [("http://h.ee", "x"), ("http://h.ee/d/e", "//cdn.x/y"), ("http://h.ee/d/e", "?q=1"), ("http://h.ee/d/e", "#top"), ("http://h.ee/d/e", "../z"), ("http://h.ee?x", "y"), ("https://h.ee/d/", "mailto:a@b")]
    assert each(spark, P.resolve(F.col("u"), F.col("v")), cases) == [urljoin(*c) for c in cases]


def test_links_of_all_tags(spark):
    def links(body, url="http://h.ee/d/e", **how):
        frame = spark.createDataFrame([(1, url, body)], "page_id long, url string, html string")
        base = P.base(F.lit(body))
        found = P.outlinks(frame, **how).withColumn("to", P.resolve(P.resolve(F.col("url"), base), F.col("href"))).orderBy("pos").collect()
        return [(r.tag, r.to, r.anchor) for r in found]

    assert links("<area href='/ar'> x <a href='/t'>A</a>") == [("area", "http://h.ee/ar", ""), ("a", "http://h.ee/t", "A")]
    assert links("<a href='/1'> apart <a href=\"2\"> from  <b>this</b></a></a>") == [("a", "http://h.ee/1", "apart"), ("a", "http://h.ee/d/2", "from this")]
    assert links("<ul><li><a href=/>one<li><a href=1>two</ul>") == [("a", "http://h.ee/", "one"), ("a", "http://h.ee/d/1", "two")]
    assert links("<frameset><frame src=\"top.html\"></frame><frame src='left.html'/></frameset>") == [("frame", "http://h.ee/d/top.html", ""), ("frame", "http://h.ee/d/left.html", "")]
    assert links("<img alt='x' src=\"l.gif\" usemap='#g'><iframe src='../docs/i.html'/><a name='bottom'/><link href='s.css'><script src='s.js'>var a = \"<a href='/no'>no</a>\";</script>") == [("img", "http://h.ee/d/l.gif", ""), ("iframe", "http://h.ee/docs/i.html", ""), ("link", "http://h.ee/d/s.css", ""), ("script", "http://h.ee/d/s.js", "")]
    assert links("<a href='/a' rel=nofollow>x</a><a rel='nofollow' href='/b'>x</a><a href='/c'></a><a href='/d'><img src='/i'></a><!-- <a href='/e'>x</a> -->") == [("a", "http://h.ee/d", ""), ("img", "http://h.ee/i", "")]
    forms = "<form method='POST' action='/p'></form><form method='GET' action='/g'><p>go</form>"
    assert links(forms) == [] and links(forms, use_form_action=True) == [("form", "http://h.ee/g", "")]
    assert links("<head><base href='http://o.ee/x/'></head><a href='y?a=1&amp;b=2#&#x41;'>&lt;t&gt; &euro;&#8364;&nope; &</a>") == [("a", "http://o.ee/x/y?a=1&b=2#A", "<t> €€&nope; &")]
    assert links("<abbr href='/n'>x</abbr><a data-href='/n'>x</a>") == [] and links(None) == [] and links("") == []


def test_unescape(spark):
    import html

    from siltstone.functions.text_parts import unescape

    texts = ["plain", "&amp;&lt;&gt;&quot;&apos;&nbsp;&eacute;&Omega;", "&#65;&#x1F600;&#xe9;", "a & b &; &unknown; &#; &#xZ; &amp;lt;", "&#0;&#xD800;&#x110000;", ""]
    assert each(spark, unescape(F.col("u")), [(t,) for t in texts] + [("&amp",)]) == [html.unescape(t) for t in texts] + ["&amp"]
    assert spark.sql("select cast(null as string) as t").select(unescape(F.col("t"))).first()[0] is None


def test_urls(spark):
    assert one(spark, U.page_key(F.col("u"), F.lit("20160101000000")), u="http://a.ee/x?q=1") == "http::a.ee::/x::q=1::20160101000000"
    assert one(spark, U.page_key(F.col("u"), F.lit("2")), u="http://a.ee/x") == "http::a.ee::/x::null::2"
    assert U.status_ranges("200-299 304 unknown") == [(200, 299), (304, 304), (-1, -1)]
    assert one(spark, U.first_rule(F.col("u"), [(False, "x"), (True, ".")]), u="http://x/") is False
    assert one(spark, U.choose_representative(F.lit("http://a.com/"), F.lit("http://a.com/x"), F.lit(True))) == "http://a.com/"
    assert one(spark, U.is_valid(F.col("u")), u="http://999.1.1.1/") is False and one(spark, U.is_valid(F.col("u")), u="http://1.2.3.4:80/a") is True


def test_html(spark):
    html = "<html lang='et'><head><title> A  b </title><meta name=\"robots\" content=\"NOINDEX, nofollow\"></head><body><script>x</script><p>Hi <a href='/y'>there</a></p></body></html>"
    frame = spark.createDataFrame([(1, "http://h.ee/d/e", html), (2, "http://h.ee/d/e", html.replace("nofollow", ""))], "page_id long, url string, html string")
    row = frame.select(P.title(F.col("html")), P.text(F.col("html")), P.language(F.col("html")), P.robots(F.col("html"))["noindex"]).first()
    assert tuple(row) == ("A b", "A b Hi there", "et", True)
    assert [tuple(r) for r in P.outlink_policy(P.outlinks(frame)).collect()] == [(2, 0, "http://h.ee/y", "there")]
    assert P.main_text("<p>" + "the word of it " * 10 + "</p><nav><a>menu</a></nav>", frozenset({"the", "of"})) == ("the word of it " * 10).strip()
    assert P.main_text("", frozenset()) is None


@pytest.mark.parametrize(
    "query,want",
    [
        ("Word", "word"), ("+word  other", "word other"), ("-word", "-word"), ("word +", "word"), ("word - +", "word"), ('" one two " " three ', '"one two" three'), ('"', ""), ('""', ""), ("f:a -g:b", "f:a -g:b"), ("the:a", "the:a"),
        ("u.s.a.", "usa"), ("the", ""), ("s", ""), ("an", "an"), ("f:the -a", "f:the -a"), ('"the"', "the"), ("+the -a", "the -a"), ('"see u.s.a. now"', '"see usa now"'), ('word"the end"', 'word "the end"'), ('word"the end', 'word "the end"'),
        ("\u3042\u3043\u4e2d", "\u3042 \u3043 \u4e2d"), ("ab\u4e2dc", "ab \u4e2d c"), ("to mari.tamm@ut.ee", '"mari tamm ut ee"'), ("com-pound", '"com pound"'), ("c++ C#", "c++ c#"), ("site:http://ut.ee/x", 'site:"http ut ee x"'), ("a_b&c", "a_b&c"),
    ],
)
def test_query_language(query, want):
    assert S.canonical(S.parse(query)) == want


def test_search_by_hand(spark):
    docs = spark.createDataFrame([(1, "the red fox", "fox", None), (2, "red the fox red", "den", "old fox"), (3, None, "", "red"), (4, "the fox", "x", None)], "doc_id long, content string, title string, anchor string")
    index = S.postings(docs, {c: F.col(c) for c in ("content", "title", "anchor")})
    found = lambda q: {r.doc_id: round(r.score, 6) for r in S.search(index, q).collect()}
    assert found("red") == {1: round(3**-0.5, 6), 2: round(2**0.5 / 2, 6), 3: 2.0}
    assert found("fox -red") == {4: round(2**-0.5, 6)}
    assert set(found('"the fox"')) == {2, 4} and set(found("anchor:fox")) == {2} and set(found("title:fox the")) == {1, 2, 4} - {2, 4} | set(found("title:fox"))
    assert found("-red") == {} and found("") == {} and found("nowhere") == {} and found("nofield:red") == {}
    assert {r.doc_id for r in S.prune(index, ["red"]).collect()} == {4}


def excerpt_by_hand(text, terms, context, budget):
    words = (text or "").split()
    plain = [re.sub(r"\W+", "", w).lower() for w in words]
    runs = []
    for i in (i for i, w in enumerate(plain) if w in terms):
        lo, hi = max(0, i - context), min(len(words), i + context + 1)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = hi
        else:
            runs.append([lo, hi])
    out, left = [], budget
    for lo, hi in sorted(runs, key=lambda w: (-len(terms & set(plain[w[0] : w[1]])), w)):
        if left > 0:
            out.append((lo, " ".join(words[lo : min(hi, lo + left)])))
            left -= hi - lo
    return " ... ".join(t for _, t in sorted(out)) or " ".join(words[:budget])


def test_summaries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "the"), (-4, "of that " * 50_000)], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for query, terms in (('the "of that" -bad', {"of", "that"}), ("der", {"der"})):
        got = {r.doc_id: r.summary for r in S.summaries(docs, query).collect()}
        assert got == {i: excerpt_by_hand(t, terms, 5, 20) for i, t in texts.items()}


def test_tokens(spark):
    assert one(spark, T.tokens(F.col("t")), t="U.S.A. C++ is 日本 foo_bar") == ["usa", "c++", "is", "日", "本", "foo_bar"]


def test_simple_link_and_matcher(spark):
    registry = spark.createDataFrame([(1, "Mari", "Tamm", 9, "Firma AS", "h1"), (2, "Mari", "Tamm", 8, "Muu OÜ", "h2")], "id_per long, first_name string, last_name string, id_org long, name_org string, row_hash string")
    mentions = spark.createDataFrame([(1, "Mari Tamm"), (1, "Firma AS"), (2, "Mari Tamm"), (3, "Keegi"), (4, "Mari"), (5, "Tartu")], "page long, name string")
    excluded = spark.createDataFrame([("Tartu", "loc", "")], "name string, tag1 string, synonym string")
    parts = E.resolve(mentions, registry, excluded)
    got = {(r.page, r.outcome, r.id) for r in E.outcomes(parts).collect()}
    assert got == {(1, "single", 9), (1, "cross", 1), (2, "noncross", None), (3, "matchless", None), (4, "excluded", None), (5, "excluded", None)}
    assert all(r.not_matchable == [] for r in E.per_page(parts).collect())


def test_crawl_update(spark):
    rows = [("a", 0x21, 10, 100.0, 0, 1.0, "s", 0), ("a", 2, 5, 100.0, 0, 2.0, "s", 0), ("b", 0x43, 7, 50.0, 0, 0.5, None, 0), ("c", 0x22, 9, 50.0, 2, 0.0, None, 0), ("c", 1, 1, 50.0, 0, 0.0, None, 0), ("d", 0x25, 9, 50.0, 0, 0.0, None, 0)]
    frame = spark.createDataFrame(rows, "url string, status long, fetch_time long, fetch_interval double, retries long, score double, signature string, modified long")
    assert {r.url: r.status for r in C.update(frame).collect()} == {"a": 6, "b": 1, "c": 3, "d": 3}
    assert {r.url for r in C.update(frame, additions=False).collect()} == {"a", "c"}


def test_archives(spark, tmp_path):
    def record(kind, body, extra=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: http://a.ee/x?q\r\nWARC-Date: 2016-01-02T03:04:05Z\r\n{extra}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n" + "<p>õun</p>".encode("latin-1")
    data = record("warcinfo", b"x") + record("response", http) + record("response", b"HTTP/1.1 404 No\r\n\r\nWARC/1.0\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in (record("warcinfo", b"x"), record("response", http))))
    (tmp_path / "c.arc").write_bytes(b"filedesc://c.arc 0.0.0.0 2016 text/plain 3\nabc\nhttp://b.ee/ 1.2.3.4 20160102030405 text/html " + str(len(http)).encode() + b"\n" + http + b"\n")
    found = archives.read_archives(spark, str(tmp_path))
    assert sorted((r.type, r.status) for r in found.collect()) == sorted([("warcinfo", -1)] * 2 + [("response", 200)] * 3 + [("response", 404)])
    pages = sorted(map(tuple, archives.responses(found).collect()))
    assert pages == sorted([("http::a.ee::/x::q::20160102030405", "<p>õun</p>")] * 2 + [("http::b.ee::/::null::20160102030405", "<p>õun</p>")])


def test_files(spark, tmp_path):
    lines = spark.createDataFrame([("t,1,Mari,Tamm,1980-01-01,9,Firma,2000-01-01,0000-00-00,juht",), ("2,Jaan,\\N,x,8,Muu,,,",), ("bad,row",)], "value string")
    rows = sorted(files.parse_registry(lines).collect(), key=lambda r: r.id_per)
    assert [(r.tag, r.id_per, r.last_name, r.end_date) for r in rows] == [("t", "1", "Tamm", None), (None, "2", None, "")]
    assert files.simple_registry(lines).count() == 1
    pages = spark.createDataFrame([("k", "<p>")], "page_id string, html string")
    files.write_sequence_file(pages, str(tmp_path / "seq"))
    assert [tuple(r) for r in files.sequence_file(spark, str(tmp_path / "seq")).collect()] == [("k", "<p>")]
    (tmp_path / "m").write_text("# no\n\n/a x\n/b\n")
    assert sorted(map(tuple, files.manifest(spark, str(tmp_path / "m")).collect())) == [("/a", "x"), ("/b", None)]
    notes = spark.createDataFrame([('{"page_id": "p", "ner": {"named_entities": ["A"], "named_entity_labels": ["PER"]}}',), ("NO_TEXT of p",), ("x",)], "value string")
    assert [tuple(r) for r in files.parse_annotations(notes).collect()] == [("p", "PER", "A")]
    assert one(spark, F.date_format(files.last_modified(F.col("d")), "yyyyMMdd"), d="2016-01-02 03:04:05") == "20160102"
    for text in ("Sat, 02 Jan 2016 03:04:05 GMT", "Sat Jan 2 03:04:05 2016", "Saturday, 02-Jan-16 03:04:05 GMT", "20160102030405"):
        assert one(spark, F.date_format(files.last_modified(F.col("d")), "yyyyMMddHHmm"), d=text) == "201601020304"
    assert one(spark, files.last_modified(F.col("d")), d="some day") is None
    files.write_new(pages, str(tmp_path / "new"))
    with pytest.raises(Exception, match="exists"):
        files.write_new(pages, str(tmp_path / "new"))
    (tmp_path / "t.txt").write_text("a\r\nb\n")
    assert [tuple(r) for r in files.text_records(spark, str(tmp_path / "t.txt")).collect()] == [("t.txt", "ab")]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(i, 1) for i in range(5)], "event_id long, user_id long").select("event_id", F.timestamp_seconds(F.col("event_id") * 600).alias("ts"), "user_id", F.lit("x").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    for turn in range(2):
        rows.withColumn("event_id", F.col("event_id") + turn * 5).coalesce(1).write.parquet(str(tmp_path / f"in{turn}"))
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / f"in{turn}").glob("part*")).rename(tmp_path / "in" / f"events{turn}.parquet")
        ingest.ingest(ingest.stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 5 * (turn + 1)


def test_baseline():
    got = baseline("Here is Mari Tamm of Tere AS. End")
    assert got["names"] == ["Mari Tamm", "Tere AS"] and got["labels"] == ["PER", "ORG"]


def test_shipping(spark, monkeypatch):
    from siltstone import shipping

    monkeypatch.setattr(shipping, "_found_anyway", lambda: False)
    monkeypatch.setattr(spark.sparkContext, "_siltstone_shipped", False, raising=False)
    shipping.ship(spark)
    assert spark.range(3).select(P.main_text_column(F.lit("<p>x"), [])).count() == 3
