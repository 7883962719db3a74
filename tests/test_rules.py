"""Rules on hand-written rows: inputs the given tables do not hold."""

import html
import math

import pytest
from pyspark.sql import functions as F

from pageloom.functions import text, urls
from pageloom.operators import corpus, dedup, inrow, jsonld, links, markup, metadata, paragraphs, prune, render, routing, runlog
from pageloom.sources import archive, visits


def one(df):
    return df.first().asDict()


def pages(spark, *html):
    return spark.createDataFrame([(i, f"https://x.example.org/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_malformed_log_lines_are_quarantined(spark, tmp_path):
    (tmp_path / "log.tsv").write_text("date\tquality\turl\n2024\tQueue\thttp://a.org/\n2024\thttp://b.org\n2024\tQ\thttp://c.org\tx\n")
    rows = {r.date + str(r.url): r.error for r in visits.read_visits(spark, str(tmp_path)).collect()}
    assert rows["2024http://a.org/"] is None
    assert sum(e is not None for e in rows.values()) == 2


@pytest.mark.parametrize(
    "query, kind, want",
    [
        ("a=1&utm_source=x&b=2", "other", "a=1&b=2"),
        ("start=30&t=5s&v=q", "youtube", "start=30&v=q"),
        ("t=5s", "other", "t=5s"),
        ("utm_term=a", "other", ""),
    ],
)
def test_query_parameters(spark, query, kind, want):
    df = spark.createDataFrame([(query, kind)], "q string, k string")
    got = df.select(urls.strip_video_timestamp(urls.strip_tracking(F.col("q")), F.col("k")).alias("x"))
    assert got.first().x == want


def test_host_less_rows_fail_and_keep_their_first_error(spark):
    df = spark.createDataFrame([("nohost/x",), ("HTTP://User:p@A.org:80/b?c#d",)], "url string")
    rows = routing.require_text(routing.parse_visits(df).withColumn("text", F.lit(""))).orderBy("url").collect()
    assert [r.error for r in rows] == ["No text", "No hostname found"]
    assert (rows[0].hostname, rows[0].netloc, rows[0].scheme) == ("a.org", "User:p@A.org:80", "http")


def test_video_id_keeps_hyphens(spark):
    df = spark.createDataFrame([("https://www.youtube.com/watch?a=1&v=ab-C_9&t=3",), ("https://x.org/",)], "url string")
    assert [r[0] for r in df.select(routing.video_id(F.col("url"))).collect()] == ["ab-C_9", None]


@pytest.mark.parametrize("iso, want", [("PT19M37S", 1177), ("PT1H2M", 3720), ("PT5S", 5), ("PT", None), ("x", None)])
def test_durations(spark, iso, want):
    df = spark.createDataFrame([(iso,)], "c string")
    assert df.selectExpr(f"{metadata.sql_duration('c')} AS s").first().s == want


def test_video_page_record(spark):
    html = """<html><head>
      <meta itemprop="name"
            content="A NEW TITLE"><meta itemprop="datePublished" content="2020-11-21"><meta itemprop="datePublished" content="2020-11-22">
      <meta itemprop="duration" content="PT19M37S"><meta itemprop="genre" content="Science &amp; Technology">
      <meta name="keywords" content="one, two,three , four"><link itemprop="thumbnailUrl" href="https://i.example.org/t.jpg"></head>
      <body><span itemprop="author"><link itemprop="url" href="http://www.youtube.com/user/someone"></span></body></html>"""
    row = one(metadata.video_page(pages(spark, html)))
    assert row["title"] == "A NEW TITLE" and row["date"] == "2020-11-21" and row["duration"] == 1177
    assert row["categories"] == ["Science & Technology"] and row["tags"] == ["one", "two", "three", "four"]
    assert row["author"] == "http://www.youtube.com/user/someone" and row["image"] == "https://i.example.org/t.jpg"


def test_bad_bytes_and_unknown_charsets_do_not_fail(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"), None), (bytearray(b"caf\xe9"), "ISO-8859-1"), (bytearray(b"x"), "klingon")], "b binary, c string")
    got = [r[0] for r in df.select(archive.decode_body(F.col("b"), F.col("c"))).collect()]
    assert got == ["a�b", "café", "x"]


def test_unclosed_tags_do_not_leak(spark):
    html = "<body><nav><ul><li><a href=/a>one<li>two</ul></nav></div><article><p>para <b>bold<p>next</article><p>after"
    rows = prune.page_blocks(pages(spark, html)).where("text_len > 0").orderBy("pos").collect()
    inside = {r.text: (r.in_nav, r.in_article) for r in rows}
    assert inside["two"] == (1, 0) and inside["para bold"] == (0, 1) and inside["next"] == (0, 1) and inside["after"] == (0, 0)


def test_script_trap(spark):
    html = '<body><script>var t="</p><p>no"</script><!-- <p>no</p> --><p>yes</p>'
    assert [r.text for r in prune.page_blocks(pages(spark, html)).where("text_len > 0").collect()] == ["yes"]


def test_link_over_block_tags_counts_as_link_text(spark):
    html = '<body><a href="/x"><div>linked words</div></a><p>plain</p>'
    rows = {r.text: r.link_len for r in prune.page_blocks(pages(spark, html)).where("text_len > 0").collect()}
    assert rows == {"linked words": 12, "plain": 0}


def test_sections_at_any_depth_and_guard(spark):
    deep = "<div>" * 40 + '<div class="sidebar"><p>side</p></div><p>kept text of the page</p>' + "</div>" * 40
    only = '<div class="sidebar"><p>all the text is here</p></div><p>x</p>'
    rows = prune.drop_sections(prune.page_blocks(pages(spark, deep, only), "boilerplate"), "boilerplate", guard=True)
    got = {(r.page_id, r.text) for r in rows.where("text_len > 0").collect()}
    assert got == {(0, "kept text of the page"), (1, "all the text is here"), (1, "x")}


def test_link_heavy_table(spark):
    cell = '<td><a href="/a">' + "linked words " * 10 + "</a></td>"
    html = f"<body><table><tr>{cell * 3}</tr></table><p>tail</p>"
    rows = prune.link_table_filter(prune.page_blocks(pages(spark, html))).where("text_len > 0")
    assert [r.text for r in rows.collect()] == ["tail"]


def test_nested_table_ends_the_outer_one(spark):
    html = "<table><tr><th>h</th><td>1</td></tr><tr><td>a<table><tr><td>in</td></tr></table></td><td>z</td></tr></table>"
    rows = render.table_cells(prune.page_blocks(pages(spark, html))).orderBy("row_no", "col_no").collect()
    assert [(r.row_no, r.col_no, r.role, r.text) for r in rows] == [(1, 1, "head", "h"), (1, 2, "cell", "1"), (2, 1, "cell", "a")]


def test_rendering(spark):
    html = '<body><h3>Head</h3><ul><li>it <i>x</i></li></ul><p>a <b>b</b><br>c <a href="/t">link</a> <a>bare</a> &lt;</p>'
    assert one(render.render(prune.page_blocks(pages(spark, html))))["text"] == "=== Head ===\n- it *x*\na **b**\nc [link](/t) [bare] <"


def test_lazy_image_first(spark):
    html = '<img src="a.gif" data-src="//i.org/b.jpg" alt="t"><img src="/no-extension">'
    assert [(r.src, r.alt) for r in render.images(pages(spark, html)).collect()] == [("http://i.org/b.jpg", "t")]


def test_paragraph_revision(spark):
    rows = [(1, i, c) for i, c in enumerate(["short", "good", "short", "good", "near", "short", "bad", "near"])]
    df = spark.createDataFrame(rows, "page_id long, pos long, class string")
    got = [r.final_class for r in paragraphs.revise_blocks(df).orderBy("pos").collect()]
    assert got == ["bad", "good", "good", "good", "good", "bad", "bad", "bad"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("by jane doe", "Jane Doe"),
        ("Jane Doe and John Roe", "Jane Doe; John Roe"),
        ("a@b.org", None),
        ("https://x.org/me", None),
        ("anna-lena schmidt", "Anna-Lena Schmidt"),
        ("Jane Doe, Jane Doe Senior", "Jane Doe"),
        ("Max Muster 3rd of May", "Max Muster"),
    ],
)
def test_author_names(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "a string")
    assert metadata.normalize_authors(df, "a").first().authors == want


def test_jsonld_forms(spark):
    docs = [
        '{"@context":"https://schema.org/","@graph":[{"@type":"WebSite","name":"http://s"},{"@type":"Organization","name":"Org Name"}]}',
        '[{"@context":"http://schema.org","@type":"NewsArticle","headline":"H","author":[{"name":["A B","C D"]},{"@type":"Organization","name":"no"}]}]',
        '{"@context":"http://other.org","@type":"Person","name":"X Y"}',
        '{"@context":"http://schema.org","@type":"Article","author":{"givenName":"Ann","familyName":"Lee"}}',
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "page_id long, js string")
    rows = jsonld.with_authors(jsonld.jsonld_fields(jsonld.jsonld_members(df))).orderBy("page_id").collect()
    assert rows[0].ld_site == "Org Name"
    assert (rows[1].ld_title, rows[1].ld_author) == ("H", "A B; C D")
    assert rows[2].ld_author is None and rows[3].ld_author == "Ann Lee"


def test_rss_with_cdata_and_plain_sitemap(spark):
    rss = "<rss><channel><item><link><![CDATA[https://a.example.org/x/1]]></link></item></channel></rss>"
    df = spark.createDataFrame([("https://a.example.org/feed", rss)], "url string, body string")
    assert [r.link for r in links.refine_links(links.feed_links(df)).collect()] == ["https://a.example.org/x/1"]
    txt = spark.createDataFrame([("https://a.org/list.txt", "see https://a.org/p1\nhttps://a.org/p2")], "url string, body string")
    assert {r.link for r in links.sitemap_links(txt).collect()} == {"https://a.org/p1", "https://a.org/p2"}


def test_sitemap_cycles_and_long_chains_end(spark):
    edges = spark.createDataFrame([("a", "b", "sitemap"), ("b", "a", "sitemap"), ("b", "c", "sitemap")], "url string, link string, state string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert {(r.url, r.depth) for r in links.expand_sitemaps(seeds, edges).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}", "sitemap") for i in range(8)], "url string, link string, state string")
    start = spark.createDataFrame([("n0",)], "url string")
    assert max(r.depth for r in links.expand_sitemaps(start, chain).collect()) == 8


def test_hot_segment_and_document_copies(spark):
    rows = [(i, 0, "the same long line") for i in range(300)] + [(i, 1, f"unique line number {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, pos long, text string")
    kept = dedup.dedup_segments(df, ["doc_id", "pos"], "text", 2, 5).collect()
    assert sorted(r.doc_id for r in kept if r.pos == 0) == [0, 1] and len(kept) == 302
    docs = df.where("pos = 0").select("doc_id", "text")
    assert [r.doc_id for r in dedup.dedup_documents(docs, "doc_id", "text").collect()] == [0]


def test_upsert_is_idempotent_and_last_writer_wins(spark, tmp_path):
    rows = [("u1", "2024-01-01", "old"), ("u1", "2024-01-02", "new"), ("u2", "2024-01-01", "x")]
    df = spark.createDataFrame(rows, "url string, visit_date string, text string").withColumn("digest", F.md5("url"))
    path = str(tmp_path / "store")
    for batch in (df.where("text = 'old'"), df, df):
        archive.upsert_processed(spark, batch, path)
    assert {(r.url, r.text) for r in archive.read_store(spark, path, df.schema).collect()} == {("u1", "new"), ("u2", "x")}
    archive.compact_store(spark, path, df.schema)
    assert sorted((r.url, r.text) for r in archive.store_of(spark, path, df.schema).read().collect()) == [("u1", "new"), ("u2", "x")]


def test_stores_with_number_like_folders_or_no_files(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(f"{n:02d}" + "0" * 30, "old") for n in range(12)] + [("1e" + "0" * 30, "old")]
    df = spark.createDataFrame(rows, "digest string, visit_date string")
    assert archive.read_store(spark, path, df.schema).count() == 0
    archive.upsert_processed(spark, df.limit(0), path)
    archive.upsert_processed(spark, df, path)
    archive.upsert_processed(spark, df.withColumn("visit_date", F.lit("p-new")), path)
    found = archive.read_store(spark, path, df.schema).collect()
    assert sorted(r.digest for r in found) == sorted(d for d, _ in rows) and {r.visit_date for r in found} == {"p-new"}


def test_empty_export_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        archive.export_json(spark.range(0), str(tmp_path / "x"))


def test_expect_and_severity_stop_the_job(spark):
    df = routing.fail_where(spark.range(2), F.col("id") == 1, "boom", "s")
    with pytest.raises(Exception, match="boom"):
        routing.expect(df).collect()
    log = spark.createDataFrame([("FAIL", "op", "bad")], "step string, operation string, error string")
    with pytest.raises(Exception, match="step failed"):
        runlog.apply_severity(log, []).collect()
    assert runlog.apply_severity(log, ["op"]).first().quarantined


def test_sampling_with_replacement_exceeds_the_kind(spark):
    df = spark.createDataFrame([("Queue", i) for i in range(3)] + [("Tool", 9)], "kind string, id long")
    rows = corpus.sample_per_kind(df, {"Queue": 50, "Tool": 20, "None": 5}, "kind", "id").collect()
    assert len(rows) == 70 and {r.id for r in rows if r.kind == "Tool"} == {9} and len({r.id for r in rows if r.kind == "Queue"}) == 3


def test_first_of_treats_empty_as_missing(spark):
    df = spark.createDataFrame([("", " ", "x")], "a string, b string, c string")
    assert df.select(text.first_of(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "x"


def test_reading_time_matches_the_formula(spark):
    for n in (0, 1, 1250, 1251):
        df = spark.createDataFrame([("x" * n,)], "t string")
        assert df.select(text.reading_time(F.col("t"))).first()[0] == math.ceil(n / 5 / 250) * 60


def texts(spark, *html):
    rows = markup.blocks(prune_rows(spark, *html)).where("text <> ''").orderBy("page_id", "pos").collect()
    return [(r.page_id, r.text) for r in rows]


def prune_rows(spark, *html):
    return markup.with_containers(markup.with_context(markup.segments(pages(spark, *html))))


def test_text_without_block_tags_is_kept(spark):
    got = texts(spark, "only words, no tags", "<html><head><title>t</title></head>Hello <p>para</p>", "<!DOCTYPE html><b>bold</b> start<p>x", "")
    assert got == [(0, "only words, no tags"), (1, "Hello"), (1, "para"), (2, "bold start"), (2, "x")]


def test_embedded_elements_with_block_tags_are_dropped(spark):
    html = "<p>a</p><noscript><p>Enable JavaScript</p></noscript><template><div>x</div></template><button><p>go</p></button><p>b</p>"
    assert texts(spark, html) == [(0, "a"), (0, "b")]


def test_a_link_around_block_tags_keeps_its_target(spark):
    df = markup.blocks(prune_rows(spark, '<div><a href="/x?a=1"><div>words</div></a><p>after</p></div>'))
    found = render.neighbors(render.render(df)).collect()
    assert [r.target for r in found] == ["/x?a=1"]


def test_every_page_has_a_row(spark):
    from pageloom.plans import extract

    df = pages(spark, "", "only words", "<p>" + "some longer words here " * 20 + "</p>")
    assert sorted(r.page_id for r in extract.extract_pages(df).collect()) == [0, 1, 2]
    assert sorted(r.page_id for r in extract.page_digest(df).collect()) == [0, 1, 2]


def test_entities_are_decoded_once(spark):
    rows = [("it&#8217;s &ecirc;t&Eacute; &#x20AC;", "it’s êtÉ €"), ("&amp;lt; &lt;", "&lt; <"), ("&amp;#65;&#38;#66;", "&#65;&#66;"), ("&#0;&#xD800;&#1114112;", "\ufffd" * 3), ("&unknown; & plain", "&unknown; & plain"), (None, None)]
    rows += [("&#38;eacute; &amp;eacute; &amp;amp;", "&eacute; &eacute; &amp;"), ("a&nbsp;b&apos;s", "a b's")]
    rows += [(f"x&{name};y &{name}", f"x{char}y &{name}") for name, char in text.NAMED.items()]
    assert len(text.NAMED) == 250 and all(html.unescape(f"&{name};") == char for name, char in text.NAMED.items() if name not in ("lang", "rang"))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, raw string, want string")
    for r in df.withColumn("a", text.unescape(F.col("raw"))).selectExpr("*", f"{text.sql_unescape('raw')} AS b").collect():
        assert r.a == r.want and r.b == r.want


def test_bodies_of_all_charsets_and_broken_ones(spark):
    rows = [(b"\x80 5", "windows-1252", "€ 5"), (b"a\xffb", "us-ascii", "a\ufffdb"), (b"\x00a\x00", "utf-16be", "a\ufffd"), (b"\xff\xfea\x00", "UTF-16", "a"), (b"\x00a", "utf-16", "a")]
    rows += [(b"caf\xe9", "ISO-8859-1", "café"), ("é".encode(), None, "é"), (b"x", "no-such-charset", "x"), (None, "utf-16", None), (b"\xff", "utf-8", "\ufffd")]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None, c, w) for i, (b, c, w) in enumerate(rows)], "i int, body binary, charset string, want string")
    for r in df.withColumn("got", archive.decode_body(F.col("body"), F.col("charset"))).collect():
        assert r.got == r.want, r


def test_scripts_are_read_one_by_one(spark):
    from pageloom.plans.page_meta import page_meta

    def script(body):
        return f'<script type="application/ld+json">{body}</script>'

    good = '{"@context":"https://schema.org","@type":"NewsArticle","headline":"H1","author":{"@type":"Person","name":"Ann Lee"}}'
    html = [
        script('{"broken": ') + script(good),
        script(f" [{good}] "),
        script('{"@context":"http://other.org","@type":"NewsArticle","headline":"no"}') + script(good),
        script('{"@type":"Article","headline": "Saved", "author": {"name": "Bob Kay"'),
    ]
    rows = page_meta(pages(spark, *[f"<html><head>{h}</head><body><p>x</p></body></html>" for h in html])).orderBy("page_id").collect()
    assert [(r.title, r.author) for r in rows] == [("H1", "Ann Lee")] * 3 + [("Saved", "Bob Kay")]


ODD_PAGES = [
    '<html><head><title>T</title></head><body><div class="post-title"><h2 class="title">Second &amp; head</h2></div><a rel="author" href="/u">Ann Lee<p>in the link</p><div>more</a></div><h1>One</h1></body></html>',
    "<div class='byline'>by Bob Kay</div><ul class=tags><li><a href='/tag/x'>x</a><li><a href='/category/y'>y</a><li><a href='/tag/x'>x</a></ul></ul><h3 id=\"title\">third head</h3>",
    '<footer><p><a href="https://creativecommons.org/licenses/by-sa/4.0/">terms</a></footer><aside class="sidebar"><p class="author">No One</p></aside><ADDRESS>Kim Poe</ADDRESS>',
    'loose <a rel=license href="/l">CC BY</a> words<article><h1></h1><h1>Two</h1><p itemprop="author">Carl May</p></article><div class="comment-list"><a rel="author" href="/n">Not Me</a></div>',
    "<script>var a = '<h1>no</h1>'</script><SELECT><h1>no</h1></select><!-- <h1>no</h1> --><h1>yes</h1><style>h1{}",
    "</div></ul><header><header class=x></header><a href='/category/z'><ul class='meta'><li>Zed</ul></a><p>tail",
    "",
]


def test_fields_of_a_page_are_those_of_its_exploded_rows(spark):
    from pageloom.plans import page_meta as pm

    df = pages(spark, *ODD_PAGES)
    rows = prune.page_blocks(df, *pm.ROWS.bits).localCheckpoint()
    want = df.select("page_id").join(metadata.heading_fields(rows).select("page_id", "n_h1", "first_h1", "first_h2", "classed"), "page_id", "left")
    for part in (metadata.page_author(rows).withColumnRenamed("author", "found_author"), metadata.page_license(rows)):
        want = want.join(part, "page_id", "left")
    topics = metadata.cats_tags(rows).withColumnsRenamed({"categories": "found_cats", "tags": "found_tags"})
    want = want.join(topics, "page_id", "left").na.fill(0, ["n_h1"])
    got = pm.structure_fields(df, "page_id").select(want.columns).orderBy("page_id").collect()
    assert got == want.orderBy("page_id").collect()
    assert [r.n_h1 for r in got] == [1, 0, 0, 2, 1, 0, 0]
    assert [r.found_author for r in got] == ["Ann Lee", "Bob Kay", "Kim Poe", "Carl May", None, None, None]


def test_rows_that_no_field_reads_get_no_text(spark):
    from pageloom.plans import page_meta as pm

    plain = "".join(f"<p>words <b>{i}</b> <a href='/{i}'>a</a></p>" for i in range(40))
    df = pages(spark, f"<h1>Head</h1><div><p class=byline>by Bob</p>{plain}</div><footer><p><a href='/f'>f</a></p></footer>")
    steps = [("segs", pm.ROWS.segments("html")), ("rows", pm.ROWS.rows(pm.ROWS.context("segs"), only=metadata.STRUCTURE_ROWS))]
    assert [r.text for r in inrow.staged(df, steps, {"rows": "rows"}).first().rows] == ["Head", "by Bob", "f"]


def test_noise_is_taken_out_of_a_page_once(spark):
    from pageloom.plans.page_meta import page_meta

    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = page_meta(pages(spark, "<p>x</p>"))._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("regexp_replace(regexp_replace(replace(") == 1


@pytest.mark.parametrize("tag, want", [('<a x="1" href="a\'b">', "a'b"), ("<a HREF = 'c\"d'>", 'c"d'), ("<a href=e>", "e"), ('<a href="">', ""), ('<a href="f>', ""), ("<a href=''g>", ""), ("<a data-href=h>", ""), ('<a href=\n"\'i">', "'i"), ("<a>", ""), (None, None)])
def test_attributes_of_a_raw_tag(spark, tag, want):
    assert spark.createDataFrame([(tag,)], "tag string").selectExpr(f"{markup.sql_attr('tag', 'href')} AS v").first().v == want


def test_hrefs_are_decoded(spark):
    html = '<html><head><link rel="canonical" href="https://a.example.org/x?a=1&amp;b=2"></head><body></body></html>'
    assert metadata.canonical_url(metadata.with_head(pages(spark, html))).first().canonical == "https://a.example.org/x?a=1&b=2"


def test_segments_without_text_are_kept(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, "short"), (2, 0, "a long enough line"), (3, 0, "a long enough line")], "doc_id long, pos long, text string")
    assert dedup.dedup_segments(df, ["doc_id", "pos"], "text", 1, 10).count() == 3


def test_transcripts_leave_other_visits_alone(spark):
    rows = [("https://www.youtube.com/watch?v=a1", "x")] + [(f"https://b.org/{i}", f"t{i}") for i in range(50)]
    visits_ = spark.createDataFrame(rows, "url string, text string")
    found = spark.createDataFrame([("a1", 200, "spoken")], "video_id string, status int, transcript string")
    got = {r.url: r.text for r in routing.with_transcript(visits_, found).collect()}
    assert len(got) == 51 and got["https://www.youtube.com/watch?v=a1"] == "spoken" and got["https://b.org/7"] == "t7"


def test_steps_that_nothing_names_are_left_out(spark):
    df = spark.createDataFrame([(1, 5)], "page_id int, x int")
    steps = [("a1", "x + 1"), ("dead", "cast(raise_error('not wanted') as int)"), ("dead2", "dead + a1"), ("b1", "a1 * 2")]
    for depth in (1, 5):
        assert [tuple(r) for r in inrow.staged(df, steps, {"b1": "b1"}, "page_id", depth=depth).collect()] == [(1, 12)]


def test_scan_of_many_items_is_right_and_not_quadratic(spark):
    """F8, F9, F10: a fold copies its state with every item, so the values emitted so far must not all stand in it."""
    import time

    from pageloom.operators.inrow import scan, struct

    running = scan("if(n > 0, sequence(1, n), cast(array() as array<int>))", struct(s="0L"), struct(s="a.s.s + x"), struct(s="a.s.s", t="a.s.s * 2"), "struct<s:bigint,t:bigint>")
    check = ["size(v) AS n", "v[size(v) - 1].s AS last", "aggregate(v, 0L, (a, e) -> a + e.t) AS total", "v[0].s AS first"]

    def timed(n: int) -> float:
        start = time.time()
        row = spark.range(1).selectExpr(f"cast(id + {n} as int) AS n").selectExpr(f"{running} AS v").selectExpr(*check).first()
        assert tuple(row) == (n + 1, n * (n + 1) // 2, n * (n + 1) * (n + 2) // 3, 0)
        return time.time() - start

    for n in (0, 1, 7, 8, 9, 63, 64, 65, 1000):
        timed(n)
    assert timed(48000) < 4 + 8 * timed(6000)
