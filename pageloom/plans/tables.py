"""Input tables, and row-wise tables derived from them.

The given `pages` hold no feeds, sitemaps, JSON-LD, videos, tables or comments, so
those inputs are derived row by row from `pages` with one SQL text that both engines
read. They grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pageloom.plans.registry import cte


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Derived:
    base: str
    columns: tuple[tuple[str, str], ...]
    where: str = "true"

    def sql(self) -> str:
        cols = ",\n  ".join(f"{e} AS {n}" for n, e in self.columns)
        return f"SELECT {cols}\nFROM {self.base} WHERE {self.where}"


DERIVED: dict[str, Derived] = {}


def derive(name: str, base: str, where: str = "true", **columns: str) -> None:
    DERIVED[name] = Derived(base, tuple(columns.items()), where)
    cte(name, DERIVED[name].sql())


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived one, by name."""
    if name not in DERIVED:
        return table(spark, sf_dir, name)
    d = DERIVED[name]
    base = load(spark, sf_dir, d.base).where(d.where)
    return base.selectExpr(*[f"{e} AS {n}" for n, e in d.columns])


PID = "cast(page_id as string)"

# Visits: the page URLs, mixed with the other site kinds and with host-less rows.
derive(
    "visits",
    "pages",
    page_id="page_id",
    date="concat('2024-01-', lpad(cast(1 + page_id % 28 as string), 2, '0'))",
    quality="case page_id % 3 when 0 then 'Queue' when 1 then 'Tool' else 'Other' end",
    url=f"""case page_id % 12
      when 1 then concat('https://www.youtube.com/watch?v=v-', {PID}, '&t=', cast(page_id % 90 as string), 's&utm_source=mail&start=3')
      when 3 then concat('https://arxiv.org/abs/', {PID}, '?utm_medium=a&x=1&utm_campaign=b')
      when 5 then concat('http://User:pw@Site', {PID}, '.GitHub.io:8080/post;v=1?a=1&utm_source=x&b=2#part')
      when 7 then concat('https://DataSkeptic.com/e/', {PID}, '/')
      when 9 then concat('relative/', {PID})
      else url end""",
)

derive(
    "archive",
    "pages",
    url="url",
    status="case when page_id % 10 = 0 then 404 else 200 end",
    content_type="""case when page_id % 7 = 0 then 'application/pdf'
      when page_id % 7 = 1 then 'application/xhtml+xml'
      when page_id % 31 = 2 then 'image/png' else 'text/html' end""",
    html="html",
)

derive(
    "video_pages",
    "pages",
    page_id="page_id",
    url=f"concat('https://www.youtube.com/watch?v=v-', {PID}, '&t=', cast(page_id % 90 as string), 's')",
    html=f"""concat('<html><head><title>x</title><meta itemprop="name" content="Video ', {PID},
      '"><meta itemprop="duration" content="PT', case when page_id % 4 = 0 then '1H' else '' end,
      cast(page_id % 60 as string), 'M', cast(page_id % 59 as string),
      'S"><meta content="2020-11-', lpad(cast(1 + page_id % 28 as string), 2, '0'), '"
        itemprop="datePublished"><meta itemprop="genre" content="Science &amp; Technology, Music"><meta name="keywords" content="a, b',
      cast(page_id % 5 as string), ',c"><link itemprop="thumbnailUrl" href="https://i.example.org/', {PID},
      '.jpg"></head><body><span itemprop="author" itemscope><link itemprop="url" href="http://www.youtube.com/user/u',
      cast(page_id % 9 as string), '"></span></body></html>')""",
)

derive(
    "transcripts",
    "pages",
    where="page_id % 3 <> 0",
    video_id=f"concat('v-', {PID})",
    status="case when page_id % 8 = 1 then 404 else 200 end",
    xml=f"concat('<transcript><text start=\"0\">hello ', {PID}, '</text><text start=\"1\">second &amp;amp; last</text></transcript>')",
)

derive(
    "jsonld_source",
    "pages",
    page_id="page_id",
    js=f"""concat('{{"@context":"https://schema.org', case when page_id % 5 = 0 then '/' else '' end, '",',
      case page_id % 6
        when 0 then concat('"@graph":[{{"@type":"Organization","name":"Site ', {PID}, '"}},{{"@type":"NewsArticle","headline":"G', {PID},
          '","author":[{{"@type":"Person","name":"ann lee"}},{{"@type":"Person","name":"bob kay ', cast(page_id % 9 as string), '"}}]}}]')
        when 1 then concat('"@type":"LiveBlogPosting","liveBlogUpdate":[{{"@type":"BlogPosting","headline":"U1"}},{{"@type":"BlogPosting","headline":"U2 ', {PID}, '"}}]')
        when 2 then concat('"@type":["Person","Thing"],"name":"carl may ', cast(page_id % 9 as string), '"')
        when 3 then concat('"@type":"Article","name":"N', {PID}, '","articleSection":["News","Sport"],"publisher":{{"@type":"Organization","name":"Daily ', {PID}, '"}}')
        when 4 then concat('"@type":"WebSite","name":"http://x.example.org","alternateName":"Alt ', {PID}, '"')
        else concat('"@type":"Article","headline":"H', {PID}, '","author":{{"@type":"Person","givenName":"ann","familyName":"lee"}},"articleSection":"Life"')
      end,
      case when page_id % 11 = 0 then '' else '}}' end)""".replace("{{", "{").replace("}}", "}"),
)

derive(
    "robots",
    "pages",
    page_id="page_id",
    base_url="concat('https://h', cast(page_id as string), '.example.org')",
    body=f"""concat('User-agent: *', chr(10), '# note', chr(10), 'SiteMap : /sitemap-', {PID}, '.xml # main', chr(13), chr(10),
      'Disallow: /x', chr(10), 'sitemap:https://cdn.example.org/s', {PID}, '.xml.gz', chr(10),
      case when page_id % 9 = 0 then repeat('#', 10000) else '' end)""",
)

# One feed body per page: RSS, Atom, JSON or a web page that names its feeds.
derive(
    "feeds",
    "pages",
    page_id="page_id",
    url=f"""case page_id % 5 when 3 then concat('https://f', {PID}, '.example.org')
      when 4 then concat('https://f', {PID}, '.example.org/blog/') else concat('https://f', {PID}, '.example.org/feed') end""",
    body=f"""case page_id % 5
      when 0 then concat(chr(10), '<?xml version="1.0"?><rss><channel><link>https://f', {PID}, '.example.org/</link><item><link><![CDATA[', url,
        ']]></link></item><item><link> /post/', {PID}, ' </link></item><item><link>https://feedproxy.example/x', {PID}, '</link></item></channel></rss>')
      when 1 then concat('<feed><link rel="self" href="https://f', {PID}, '.example.org/feed"/><link rel="alternate" href="', url,
        '"/><link type="application/atom+xml" href="/other"/><link href="/entry/', {PID}, '"/></feed>')
      when 2 then concat('{{"version":"1.1","items":[{{"url":"', url, '"}},{{"id":"https://f', {PID}, '.example.org/id/1"}},{{"title":"none"}}]}}')
      when 3 then concat('<html><head><link rel="alternate" type="application/rss+xml" href="/feed"><link rel="alternate" href="/comments/atom"></head><body>',
        '<a href="/x.rss">x</a></body></html>')
      else concat('<html><body><a href="/a/b.rss">rss</a><a href="https://f', {PID}, '.example.org/index.atom?a=1&amp;b=2">a</a><a href="/plain">p</a></body></html>')
      end""".replace("{{", "{").replace("}}", "}"),
)

# Stored bodies behind the feeds that the pages above name.
derive(
    "feed_bodies",
    "pages",
    where="page_id % 5 >= 3",
    url=f"case page_id % 5 when 3 then concat('https://f', {PID}, '.example.org/feed') else concat('https://f', {PID}, '.example.org/a/b.rss') end",
    body=f"""concat('<rss><channel><item><link>https://f', {PID}, '.example.org/blog/one?utm_source=feed</link></item><item><link>https://f',
      {PID}, '.example.org/blog/two</link></item></channel></rss>')""",
)

# Sitemaps: an index per host names a child, the child names pages and the index again.
derive(
    "sitemaps",
    "pages",
    page_id="page_id",
    url=f"""case page_id % 4 when 0 then concat('https://s', {PID}, '.example.org/sitemap.xml')
      when 1 then concat('https://s', cast(page_id - 1 as string), '.example.org/child.xml')
      when 2 then concat('https://s', cast(page_id - 2 as string), '.example.org/deep.xml')
      else concat('https://s', cast(page_id - 3 as string), '.example.org/list.txt') end""",
    body=f"""case page_id % 4
      when 0 then concat('<?xml version="1.0"?><sitemapindex><sitemap><loc>https://s', {PID}, '.example.org/child.xml</loc></sitemap><sitemap><loc><![CDATA[https://s',
        {PID}, '.example.org/missing.xml]]></loc></sitemap></sitemapindex>')
      when 1 then concat('<?xml version="1.0"?><urlset><url><loc> https://s', cast(page_id - 1 as string), '.example.org/en/', {PID},
        '/ </loc><xhtml:link rel="alternate" hreflang="de" href="https://s', cast(page_id - 1 as string), '.example.org/de/', {PID},
        '"/><xhtml:link rel="alternate" hreflang="x-default" href="https://s', cast(page_id - 1 as string), '.example.org/all/', {PID},
        '"/></url><url><loc>https://s', cast(page_id - 1 as string), '.example.org/deep.xml</loc></url><url><loc>https://s', cast(page_id - 1 as string),
        '.example.org/sitemap.xml</loc></url><url><loc>', url, '</loc></url></urlset>')
      when 2 then concat('<urlset><url><loc>https://s', cast(page_id - 2 as string), '.example.org/fr/', {PID},
        '</loc></url><url><loc>https://s', cast(page_id - 2 as string), '.example.org/list.txt?x=.xml#a</loc></url><url><loc>https://me.wordpress.com/p', {PID}, '</loc></url></urlset>')
      else concat('https://s', cast(page_id - 3 as string), '.example.org/t/', {PID}, chr(10), 'text https://s', cast(page_id - 3 as string), '.example.org/more.xml end')
      end""",
)

# Starts of a sitemap search: a home page, a sitemap, a page below a host with a robots file, a host without anything.
derive(
    "search_starts",
    "pages",
    url=f"""case page_id % 4 when 0 then concat('https://s', {PID}, '.example.org') when 1 then concat('https://s', cast(page_id - 1 as string), '.example.org/child.xml')
      when 2 then concat('https://h', {PID}, '.example.org/a') else concat('https://g', {PID}, '.example.org/') end""",
)
# Sitemaps that only a robots file names, or that lie in one of the usual places.
derive(
    "search_bodies",
    "pages",
    where="page_id % 4 >= 2",
    url=f"case page_id % 4 when 2 then concat('https://h', {PID}, '.example.org/sitemap-', {PID}, '.xml') else concat('https://g', {PID}, '.example.org/sitemap_index.xml') end",
    body=f"""concat('<urlset><url><loc>https://', case page_id % 4 when 2 then 'h' else 'g' end, {PID}, '.example.org/a/', {PID}, '</loc></url><url><loc>https://',
      case page_id % 4 when 2 then 'h' else 'g' end, {PID}, '.example.org/b/', {PID}, '</loc></url></urlset>')""",
)
# Step log: one INIT and one outcome per event.
derive(
    "step_outcomes",
    "events",
    event_id="event_id",
    digest="md5(cast(event_id as string))",
    operation="concat('op', cast(user_id % 4 as string))",
    kind="case user_id % 3 when 0 then 'youtube' when 1 then 'arxiv' else 'other' end",
    step="case event_type when 'error' then 'FAIL' when 'signup' then 'WARN' else 'DONE' end",
    start="cast(event_id % 1000 as double)",
    duration="round(abs(value), 2)",
)

_META = f"""concat('<head><meta property="og:title" content="OG ', {PID}, '"><meta name="Author" content="by jane doe and ann lee ', cast(page_id % 7 as string),
    '"><meta name="description" content="About &lt;b&gt; ', {PID}, '"><meta content="a, b&quot;, c', cast(page_id % 3 as string), '" name="keywords">',
    case when page_id % 4 = 0 then concat('<meta property="og:site_name" content="site ', {PID}, '"><meta property="og:url" content="https://og.example.org/', {PID},
      '"><meta property="og:description" content="Ogd"><meta property="og:author" content="Og Author">') else '<meta name="twitter:site" content="@tweeter">' end,
    case page_id % 3 when 0 then concat('<link rel="canonical" href="/c/', {PID}, '?a=1&amp;b=2">') when 1 then concat('<link href="https://can.example.org/', {PID},
      '/" rel="canonical">') else concat('<link rel="alternate" hreflang="x-default" href="https://alt.example.org/', {PID}, '">') end,
    '<meta name="twitter:image" content="https://tw.example.org/', {PID}, '.png"><link rel="icon" href="/icon.png">',
    '<meta property="article:published_time" content="2023-0', cast(1 + page_id % 9 as string), '-15T10:00:00Z"><meta itemprop="headline" content="Headline">',
    '<script type="application/ld+json">{{"@context":"https://schema.org","@type":"NewsArticle","headline":"LD ', {PID},
    '","articleSection":"Politics","publisher":{{"@type":"Organization","name":"Pub ', cast(page_id % 5 as string),
    '"}},"author":{{"@type":"Person","name":"kim poe"}},"articleBody":"Body \\"quoted\\" ', {PID}, '"}}</script>')""".replace("{{", "{").replace("}}", "}").replace('\\"quoted\\" ', "quoted ")

_BEFORE = f"""concat('<header><h2>Site head</h2></header><div class="teaser-box"><p>Teaser text for page ', {PID},
    '</p><a href="/t1">t1</a></div><div class="post-content" id="c', {PID}, '"><p class="byline">By <a rel="author" href="/author/jane">Jane Doe</a></p>',
    '<div class="cookie-banner">We use cookies, accept them.</div><article class="post">')"""

_AFTER = f"""concat('<div class="paywall-note"><p>Subscribe to read the rest of it.</p></div>loose text, in the article<blockquote>A quote, of size.</blockquote>',
    '<ul><li>first item</li><li><a href="/l1">link one</a></li><li>third <i>item</i></ul>',
    '<table><tr><th>Key</th><th>Value</th></tr><tr><td>page</td><td>', {PID}, '</td></tr><tr><td><p>long</p><p>cell</p></td><td><table><tr><td>inner</td></tr></table></td></tr></table>',
    '<figure><img data-src="//img.example.org/', {PID}, '.jpg" src="lazy.gif" alt="Alt ', {PID}, '"><figcaption class="caption">A caption</figcaption></figure>',
    '<div class="share-links"><a href="/s1">Facebook</a> <a href="/s2">Twitter</a></div><div>Read more</div><div><a href="/rm">Read more</a></div><div><a href="/rm2">Read more</a></div><div><a href="/rm3">Read more</a></div>',
    '<noscript><p>Enable it</p></noscript><template><div>hidden</div></template><a href="/wide"><div>wide words</div></a><p>Facebook</p><p>See <a href="https://ref.example.org/', {PID}, '">the <b>reference</b></a> and <code>code</code>.</p><h3>Related</h3></article>',
    '<div id="comments" class="comment-list"><p class="comment-meta">Posted by x</p><p>First comment on ', {PID}, ', nice read.</p><div class="comment-form">Reply here</div></div>',
    '<form><input type="text"><input type="hidden">Sign up</form></div><div class="tags"><a href="/tag/one">One</a><a href="/tag/two">Two</a><a href="/category/cat">Cat</a></div>',
    '<div class="footer"><a href="https://creativecommons.org/licenses/by-sa/4.0/">terms</a></div>')"""

# Pages with metadata, tables, images, comments and noise sections around the given text.
derive(
    "rich_pages",
    "pages",
    page_id="page_id",
    url="url",
    html=f"""concat(replace(replace(replace(html, '<head>', {_META}), '<article>', {_BEFORE}), '</article>', {_AFTER}),
      case when page_id % 13 = 0 then '<p>tail after the page</p>' else '' end)""",
)
