"""Operators of the corpus engine on literal rows."""

import gzip
import inspect
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftline import cli, config
from weftline.functions import language, links, text, urls
from weftline.operators import crawl, merge, quality, stats, taxonomy, tree
from weftline.plans import cases, catalog
from weftline.sources import blobs, http, pages, sitemap
from weftline.sources.tables import Store
from weftline.streaming import ingest

SF = "/root/testdata/sf0.001"


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLES)))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda d: sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_urls(spark):
    u = "https://User@Sub.Example.org:8080/a_b/Ä.pdf?x=1&&y=#z"
    assert one(spark, urls.host(F.col("u")), u=u) == "sub.example.org"
    assert one(spark, urls.relative(F.col("u")), u=u) == "/a_b/Ä.pdf?x=1&&y="
    assert one(spark, F.size(urls.query_pairs(F.col("u"))), u=u) == 2
    assert one(spark, urls.route_kind(F.lit(None).cast("string"), F.col("u")), u=u) == "pdf"
    assert one(spark, urls.route_kind(F.lit("Text/HTML; charset=x"), F.col("u")), u="http://h/a") == "html"
    assert one(spark, urls.in_domain(F.col("u"), F.lit("example.org")), u=u)
    assert not one(spark, urls.in_domain(F.col("u"), F.lit("ample.org")), u=u)
    assert one(spark, urls.is_trap(F.col("u")), u="http://moodle2.x.de/a") and one(spark, urls.is_trap(F.col("u")), u="http://x.de/a?tx%5Fsolr[q]=1")
    assert not one(spark, urls.is_trap(F.col("u")), u="http://x.de/moodle")
    assert one(spark, urls.title_from_url(F.col("u")), u="http://x.de/a/Mein_Bericht-2%20neu+.pdf") == "Mein Bericht 2 neu+"
    assert one(spark, urls.title_from_url(F.col("u")), u="http://x.de/a/") is None


def test_text(spark):
    assert one(spark, text.normalize(F.col("t")), t=" ü    b\x1cc ") == "ü b c"
    assert one(spark, text.word_count(F.col("t")), t="a b c\x85d\x1ce f") == 6
    assert one(spark, text.word_count(F.col("t")), t=None) == 0
    md = "# Head\n\n- *one* [two](http://x)\n> ![pic](y)quote\n---\n| a | b |"
    assert one(spark, text.markdown_to_text(F.col("t")), t=md).split() == ["Head", "one", "two", "quote", "a", "b"]
    assert one(spark, text.heading_title(F.col("t")), t="x\n# The title \n# b") == "The title"
    for junk in ("Untitled", "Microsoft Word - a.doc", "scan 1.PDF", "  "):
        assert one(spark, text.clean_title(F.col("t")), t=junk) is None
    assert one(spark, text.clean_title(F.col("t")), t=" A title ") == "A title"
    assert one(spark, language.detect(F.col("t")), t="the cat is in the house and it was not of the dog") == "en"
    assert one(spark, language.detect(F.col("t")), t="der Hund") is None


def test_quality(spark):
    reason = lambda t, m=None: one(spark, quality.reject_reason(F.col("t"), F.col("m")), t=t, m=m)
    assert reason(None) == reason("  ") == "empty"
    assert reason("a b") == "too short: 2 words"
    assert reason("Wir verwenden Cookies. Alle akzeptieren " + "w " * 60) == "boilerplate/cookie"
    assert reason("Wir verwenden Cookies. " + "w " * 60) == "ok"
    assert reason("w " * 60, "[" + "w " * 50 + "](http://x)") == "boilerplate/nav-only"
    assert reason("w " * 60, "![" + "w " * 50 + "](http://x)") == "ok"


def test_links(spark):
    html = '<A HREF="/für?q=a b#top">1</A><a href="mailto:x@y">2</a><a href="//Other.de:443/x">3</a><a href="/f%C3%BCr?q=a%20b">4</a><a href="http://[::1">5</a>'
    assert links.links_of(html, "https://x.de/d/") == ["https://x.de/f%C3%BCr?q=a%20b", "https://other.de/x"]
    assert links.links_of(None, "https://x.de") == links.links_of("", None) == []
    pages = spark.createDataFrame([("https://x.de/", html), ("https://x.de/2", None)], "url string, html string")
    edges = links.link_edges(pages)
    assert links.followable(edges).count() == 1 and edges.count() == 2
    assert stats.top_external(edges).collect()[0].host == "other.de"
    assert [r.url for r in stats.without_links(pages, edges).collect()] == ["https://x.de/2"]


def repeated(spark, path):
    """pages where a URL has three rows, of which two differ; the catalog's SQL over them."""
    rows = [(0, "https://x.de/", '<a href="/a">1</a><a href="/b">2</a>'), (1, "https://x.de/", '<a href="/b">1</a><a href="/c">2</a>'), (2, "https://x.de/", '<a href="/b">1</a><a href="/c">2</a>'), (3, "https://x.de/2", '<a href="/a">1</a>'), (4, "https://x.de/3", None)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{path}/pages.parquet/*.parquet'")
    return lambda name: sorted(con.sql(catalog.ORACLES[name]).fetchall())


def test_link_edges_of_repeated_urls(spark, tmp_path):
    sql = repeated(spark, tmp_path)
    got = catalog.link_edges(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sql("link_edges") == [("https://x.de/", 3, 3, 0), ("https://x.de/2", 1, 1, 0)]
    edges = links.link_edges(spark.read.parquet(f"{tmp_path}/pages.parquet")).where("src = 'https://x.de/'")
    assert {(r.dst[-1], r.pos) for r in edges.collect()} == {("a", 0), ("b", 0), ("c", 1)}


def test_link_totals_of_repeated_urls(spark, tmp_path):
    sql = repeated(spark, tmp_path)
    assert sorted(map(tuple, catalog.link_totals(spark, str(tmp_path)).collect())) == sql("link_totals") == [(4, 4, 0, 2)]


def incoming(spark, *rows):
    return spark.createDataFrame([(u, u, "s", "html", t, None, t, "de", t) for u, t in rows], "url string, final_url string, site string, source_type string, content_sha256 string, title string, text string, lang string, text_sha256 string")


def state(df):
    return {r.url: (r.outcome, r.present, r.revision, r.updated_at) for r in df.collect()}


def test_upsert_lifecycle(spark):
    first = merge.upsert(catalog._empty_snapshot(incoming(spark, ("a", "x"))), incoming(spark, ("https://h/p?c=1", "x"), ("https://h/q", "y")), "1")
    assert state(first) == {"https://h/p?c=1": ("new", True, 1, "1"), "https://h/q": ("new", True, 1, "1")}
    same = merge.upsert(first.drop("outcome"), incoming(spark, ("https://h/q", "y")), "2")
    assert state(same)["https://h/q"] == ("unchanged", True, 1, "1")
    # a cleaner URL takes over, a changed text counts up, a loser without a row makes none
    third = merge.upsert(same.drop("outcome"), incoming(spark, ("https://h/p", "x"), ("https://h/q", "z"), ("https://h/q?a=1", "z")), "3")
    assert state(third) == {"https://h/p?c=1": ("retired", False, 1, "3"), "https://h/p": ("new", True, 1, "3"), "https://h/q": ("changed", True, 2, "3")}
    up, gone = merge.delta(third, "2")
    assert up.count() == 2 and [r.url for r in gone.collect()] == ["https://h/p?c=1"]
    # removed and back again
    removed = merge.remove(third.drop("outcome"), spark.createDataFrame([("https://h/q",)], "url string"), "4")
    assert merge.remove(removed, spark.createDataFrame([("https://h/q",)], "url string"), "5").where("updated_at = '5'").count() == 0
    back = merge.upsert(removed, incoming(spark, ("https://h/q", "z")), "6")
    assert state(back)["https://h/q"] == ("unchanged", True, 2, "6")
    again = merge.retire_duplicates(back.drop("outcome"), "7")
    assert again.where("updated_at = '7'").count() == 0


def test_crawl(spark):
    f = spark.createDataFrame(
        [("https://x.de/1", "https://x.de/1", 304, None, None), ("https://x.de/2", "https://x.de/2", 200, "text/html", b""), ("https://x.de/3", "https://x.de/3", 410, None, None), ("https://x.de/4", "https://x.de/4", 503, None, None), ("https://x.de/5", "https://y.de/", 200, "text/html", b"a"), ("https://x.de/6", "https://x.de/6", 200, "image/png", b"a"), ("https://x.de/7", "https://x.de/7", 200, "text/html", b"a"), ("https://x.de/8", "https://x.de/8", 200, "text/html", b"a")],
        "url string, final_url string, status int, content_type string, data binary",
    ).selectExpr("*", "'e' etag", "cast(null as string) last_modified", "cast(null as string) error")
    known = spark.createDataFrame([("https://x.de/1", "h"), ("https://x.de/8", "h"), ("https://x.de/3", "h")], "url string, content_sha256 string").selectExpr("*", "true present", "'old' etag", "'m' last_modified")
    out = crawl.outcomes(f, known)
    assert [r.outcome for r in out.orderBy("url").collect()] == ["unchanged", "skipped", "removed", "error", "skipped", "skipped", "new", "changed"]
    kept = {r.url[-1]: (r.keep_etag, r.keep_modified) for r in out.collect()}
    assert kept["1"] == ("e", "m") and kept["3"] == (None, None)
    assert blobs.new_blobs(out).count() == 1
    site = {"https://x.de/": '<a href="/a">a</a><a href="/b">b</a><a href="https://z.de/">z</a>', "https://x.de/a": '<a href="/c">c</a><a href="/calendar/view.php">t</a>', "https://x.de/b": "b", "https://x.de/c": "c"}
    table = spark.createDataFrame([(u, u, 200, "text/html", h.encode()) for u, h in site.items()], "url string, final_url string, status int, content_type string, data binary").selectExpr("*", "cast(null as string) etag", "cast(null as string) last_modified", "cast(null as string) error")
    seeds = spark.createDataFrame([("https://x.de/", "x")], "url string, site string")
    done = crawl.crawl(seeds, lambda c: table.join(c.select("url"), "url"), lambda name, k, df: df.checkpoint() if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df)
    assert {(r.url, r.depth) for r in done.collect()} == {("https://x.de/", 0), ("https://x.de/a", 1), ("https://x.de/b", 1), ("https://x.de/c", 2)}
    q = spark.createDataFrame([("a", "done", 200, True), ("b", "error", 503, True), ("c", "error", 404, True), ("d", "in_progress", None, True)], "url string, work_state string, http_status int, present boolean").selectExpr("*", "'e' etag", "'m' last_modified")
    states = lambda m, r: [x.work_state for x in crawl.requeue(q, m, r).orderBy("url").collect()]
    assert states("all", True) == ["pending", "pending", "error", "pending"] and states("new-only", False) == ["done", "error", "error", "pending"]
    urls_ = spark.createDataFrame([("a", "done", "2024"), ("b", "done", None), ("c", "done", "2024")], "url string, work_state string, sitemap_lastmod string")
    seen = spark.createDataFrame([("a", "2025"), ("b", "2025"), ("c", "2023"), ("d", None)], "url string, lastmod string")
    assert {(r.url, r.work_state, r.sitemap_lastmod) for r in crawl.merge_sitemap(urls_, seen).collect()} == {("a", "pending", "2025"), ("b", "done", "2025"), ("c", "done", "2024"), ("d", "pending", None)}


def test_sitemap(spark):
    xml = "<sitemapindex><sitemap><loc>http://x/2.xml</loc></sitemap></sitemapindex>"
    two = "<url><loc>http://x/a?b=1&amp;c</loc><lastmod>2024</lastmod></url><url><loc><![CDATA[http://x/b]]></loc></url><sitemap><loc>http://x/1.xml</loc></sitemap>"
    data = spark.createDataFrame([("http://x/1.xml", bytearray(xml.encode())), ("http://x/2.xml", bytearray(gzip.compress(two.encode())))], "url string, data binary")
    got = sitemap.discover(spark, ["http://x/1.xml"], lambda t: data.join(t, "url"), lambda n, k, df: df)
    assert {(r.url, r.lastmod) for r in got.collect()} == {("http://x/a?b=1&c", "2024"), ("http://x/b", None)}
    robots = spark.createDataFrame([("User-agent: *\nSITEMAP : http://x/s.xml\nsitemap:\n",)], "text string")
    assert [r.url for r in sitemap.robots_sitemaps(robots).collect()] == ["http://x/s.xml"]


def test_crawl_and_sitemaps_have_no_silent_end(spark):
    keep = lambda name, k, df: df.sparkSession.createDataFrame(df.collect(), df.schema)
    pages = [(f"https://x.de/{i}", f"https://x.de/{i}", 200, "text/html", f'<a href="/{i + 1}">n</a>'.encode()) for i in range(4)]
    table = spark.createDataFrame(pages, "url string, final_url string, status int, content_type string, data binary").selectExpr("*", "cast(null as string) etag", "cast(null as string) last_modified", "cast(null as string) error")
    seeds = spark.createDataFrame([("https://x.de/0", "x")], "url string, site string")
    with pytest.raises(RuntimeError, match="left after 2 waves"):
        crawl.crawl(seeds, lambda c: table.join(c.select("url"), "url"), keep, most_waves=2)
    assert inspect.signature(crawl.crawl).parameters["most_waves"].default is None
    levels = [(f"http://x/{i}.xml", f"<sitemap><loc>http://x/{i + 1}.xml</loc></sitemap><url><loc>http://x/p{i}</loc></url>".encode()) for i in range(24)]
    data = spark.createDataFrame(levels, "url string, data binary")
    fetch = lambda todo: data.join(todo, "url")
    assert sitemap.discover(spark, ["http://x/0.xml"], fetch, keep).count() == 24
    with pytest.raises(RuntimeError, match="left after 2 levels"):
        sitemap.discover(spark, ["http://x/0.xml"], fetch, keep, most=2)


def test_taxonomy_tree_and_findings(spark):
    c = one(spark, taxonomy.classify(F.col("u"), F.col("t"), F.lit(None).cast("string"), catalog.RULES), u="https://www.example.com/News/x_y", t="our code")
    assert (c.campus, c.department, c.program, c.department_source) == ("north-annex", "tech", None, "keyword")
    c = one(spark, taxonomy.classify(F.col("u"), F.col("t"), F.col("t"), catalog.RULES), u="https://other.de/docs-2/a", t="code music")
    assert (c.campus, c.program, c.department) == (None, "p-two", "arts")
    items = [("https://h/", None, "done"), *((f"https://h/{i}", "https://h/", "done") for i in range(5)), ("https://h/e", "https://h/0", "error")]
    nodes, cut, kept = tree.build(items, most_children=3)
    assert kept == 6 and not cut and [n["label"] for n in nodes] == ["", "/", "+2 more", "/0", "/1", "/2"]
    deep = [("u0", None, "done"), *((f"u{i}", f"u{i - 1}", "done") for i in range(1, 3000))]
    assert tree.build(deep, most_nodes=100)[1]
    sites = spark.createDataFrame([("a", 1000, 200, 0.5), ("b", 10, 0, 0.0), ("c", 1000, 0, 0.0)], "site string, docs long, error long, error_rate double")
    assert [f["sev"] for f in stats.findings(sites, 2010, 0, 50, {"distinct_src": 2000, "total": 9})] == ["crit", "info"]


def test_percentiles_and_stream(spark, tmp_path):
    d = spark.createDataFrame([(x,) for x in (10, 30, 66, 217, 382, 732)], "word_count int")
    assert stats.percentiles(d, percents=(50,)).first().value == 217
    pd.DataFrame({"url": ["https://x.de/"], "html": ['<a href="/a">a</a>']}).to_parquet(tmp_path / "in.parquet")
    (tmp_path / "src").mkdir()
    os.rename(tmp_path / "in.parquet", tmp_path / "src/in.parquet")
    stream = spark.readStream.schema("url string, html string").parquet(str(tmp_path / "src"))
    ingest.ingest(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out/links")).first().dst == "https://x.de/a"


def test_tables_cli_and_settings(spark, tmp_path, capsys):
    (tmp_path / "config.toml").write_text('[[sites]]\nname = "x"\nseed_url = "https://x.de/"\nallowed_domain = "x.de"\n[crawl]\nuser_agent = "t"\nuse_sitemap = false\n[storage]\nfolder = "data"\n')
    s = config.load(tmp_path / "config.toml")
    assert config.find(tmp_path / "a" / "b") == tmp_path / "config.toml" and config.choose(s, ["x.de"]) == s.sites
    with pytest.raises(SystemExit):
        config.choose(s, ["y"])
    (tmp_path / "bad.toml").write_text('[[sites]]\nname = "x"\nseed_url = "u"\nallowed_domain = "d"\n[crawl]\nuser_agent = "t"\nrecheck = "never"\n[storage]\nraw_dir = "r"\n')
    with pytest.raises(ValueError, match="recheck"):
        config.load(tmp_path / "bad.toml")
    store = Store(spark, s.folder)
    assert store.read("queue").count() == 0
    long = "<title>Page</title><p>" + "word " * 70 + '</p><a href="/b">b</a>'
    web = {"https://x.de/": long, "https://x.de/b": long.replace("word", "other")}
    answers = lambda wave: spark.createDataFrame([(u, u, 200, "text/html", bytearray(h.encode()), None, None, None) for u, h in web.items()], http.SCHEMA).join(wave.select("url"), "url")
    assert cli.fetch(store, s, fetcher=answers)["x.de"]["new"] == 2
    assert cli.run_extract(store, s) == {"indexed": 2, "rejected": 0, "error": 0}
    assert cli.dedup(store) == {"before": 2, "retired": 0, "after": 2} and cli.backfill(store)["documents"] == 2
    assert cli.fetch(store, s, fetcher=answers)["x.de"]["unchanged"] == 2
    web["https://x.de/b"] = "<p>changed</p>"
    assert cli.fetch(store, s, fetcher=answers)["x.de"]["changed"] == 1 and store.read("crawl_log").count() == 6 and store.read("links").count() == 2
    assert cli.run_extract(store, s) == {"indexed": 0, "rejected": 1, "error": 0} and len(cli.delta(store, "")["upserts"]) == 2
    counts = cli.counts(store)
    assert counts["documents"] == 2 and counts["queue_done"] == 2 and counts["rejects"] == {"too short: 1 words": 1}
    page = cli.render(cli.payload(store, s))
    assert "under-covered" in page and "</script></script>" not in page
    assert cli.main(["--config", str(tmp_path / "config.toml"), "stats"], spark) == 0 and '"documents": 2' in capsys.readouterr().out
    assert store.vacuum("queue") >= 2 and store.read("queue").count() == 2
    assert cli.reset(store, s, ["x"])["x"]["queue"] == 2 and store.read("queue").count() == 0 and store.read("raw_docs").count() == 3
    assert cli.size_text(1536) == "1.5 KB" and "</" not in cli.island("</script>")


def test_known_bytes_after_removal_and_304_edges(spark):
    queue, got, edges = cases.crawled(spark, "new-only")
    assert {r.url for r in got.collect()} == {"https://x.de/s"}
    up = merge.intern(spark.createDataFrame([(7, "b")], "id long, name string"), spark.createDataFrame([("a",), ("ü",), ("b",), ("c",), ("a",), (None,)], "name string"), "name")
    assert {(r.name, r.id) for r in up.collect()} == {("b", 7), ("a", 8), ("c", 9), ("ü", 10)}


def test_pdf_seam():
    doc = pages.extract_pdf(b"x", lambda b: "# Title\n\n- *one* two", lambda b: "Untitled")
    assert doc["title"] == "Title" and doc["text"].split() == ["Title", "one", "two"]
    assert pages.extract_pdf(b"x", lambda b: "text only", lambda b: "Microsoft Word - a.doc")["title"] is None and pages.extract_pdf(b"x", lambda b: " ") is None


def test_robots_in_domain(spark):
    robots = spark.createDataFrame([("https://x.de/robots.txt", bytearray(b"Sitemap: https://a.x.de/s.xml\nSitemap: https://y.de/s.xml"))], "url string, data binary")
    assert sitemap.seeds_of(spark, "https://x.de", "x.de", lambda t: robots.join(t, "url")) == ["https://x.de/sitemap.xml", "https://a.x.de/s.xml"]
    data = spark.createDataFrame([("s", bytearray(b"<url><loc>https://x.de/a</loc><lastmod>2025</lastmod></url><url><loc>https://x.de/a</loc><lastmod>2024</lastmod></url><url><loc>https://y.de/a</loc></url>"))], "url string, data binary")
    assert [(r.url, r.lastmod) for r in sitemap.discover(spark, ["s"], lambda t: data.join(t, "url"), lambda n, k, df: df, domain="x.de").collect()] == [("https://x.de/a", "2024")]
