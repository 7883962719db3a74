"""Queries over feeds, sitemaps and robots files."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions import urls
from pageloom.operators import links
from pageloom.plans import markup_sql as d
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load
from pageloom.plans.url_queries import d_base, d_clean, d_domain, d_host, d_lang, d_path, d_resolve, d_valid

from pageloom.plans.text_queries import d_unescape  # noqa: E402

L = links
D_BARE = "ltrim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
D_KIND = f"case when regexp_matches({D_BARE}, '{L.FEED_START}') or contains(substr({D_BARE}, 1, 100), '<rss') or contains(substr({D_BARE}, 1, 100), '<feed') then 'xml' when starts_with({D_BARE}, '{{') then 'json' else 'none' end"


def feed_link_cte(prefix: str, source: str) -> None:
    cte(
        f"{prefix}feed_raw",
        f"""SELECT url, kind, link FROM (SELECT url, kind, unnest(case
  when kind = 'json' then list_transform(json_extract(body, '$.items[*]'), lambda x: coalesce(json_extract_string(x, '$.url'), json_extract_string(x, '$.id')))
  when kind = 'xml' and contains(body, '<link ') then list_transform(list_filter(regexp_extract_all(body, '{L.ATOM_LINK}', 0), lambda x: not (contains(x, 'atom+xml') or contains(x, 'rel="self"'))), lambda x: {d.d_attr('x', 'href')})
  when kind = 'xml' then list_transform(regexp_extract_all(body, '{L.RSS_LINK}', 1), lambda x: trim(x)) else [] end) AS link
FROM (SELECT url, case when {D_KIND} = 'json' then body else body end AS body, {D_KIND} AS kind FROM (SELECT url, regexp_replace(body, '^\\s+|\\s+$', '', 'g') AS body FROM {source}))) WHERE link <> ''""",
    )
    # Two steps, so that each link is resolved and cleaned once.
    cte(
        f"{prefix}feed_full",
        f"""SELECT url, link, {d_clean('r')} AS full_link FROM (SELECT url, link, {d_resolve('b', 'link')} AS r FROM (SELECT url, link, {d_base('url')} AS b FROM {prefix}feed_raw))""",
    )
    page = f"{d_valid('full_link')} and not regexp_matches({d_path('full_link')}, '{urls.ASSET_FILE}') and not regexp_matches({d_path('full_link')}, '{urls.IMAGE_FILE}')"
    cte(
        f"{prefix}feed_refined",
        f"""SELECT DISTINCT url, link FROM (SELECT url, case when {page} then full_link when regexp_matches(link, '{urls.FEED_PROXY}') then link end AS link FROM {prefix}feed_full)
WHERE link is not null and link <> url and length(link) - length(replace(link, '/', '')) > 2""",
    )


feed_link_cte("", "feeds")


def feeds(spark, sf_dir):
    return load(spark, sf_dir, "feeds")


# Every fourth body starts with line breaks.
@query("feed_kind", "G1", f"SELECT page_id, {D_KIND} AS kind FROM (SELECT page_id, case when page_id % 4 = 0 then chr(10) || chr(9) || body else body end AS body FROM feeds)")
def q_feed_kind(spark, sf_dir):
    shifted = feeds(spark, sf_dir).selectExpr("page_id", "case when page_id % 4 = 0 then concat('\n\t', body) else body end AS body")
    return shifted.selectExpr("page_id", f"{L.feed_kind()} AS kind")


@query("feed_links", "G2", "SELECT url, kind, link FROM feed_raw")
def q_feed_links(spark, sf_dir):
    return L.feed_links(feeds(spark, sf_dir).drop("page_id")).select("url", "kind", "link")


@query("refine_links", "G3", "SELECT * FROM feed_refined")
def q_refine_links(spark, sf_dir):
    return L.refine_links(L.feed_links(feeds(spark, sf_dir)))


cte(
    "feed_named",
    f"""SELECT url, href, 1 AS rank FROM (SELECT url, {d_unescape(d.d_attr('x', 'href'))} AS href, {d.d_attr('x', 'type')} AS type, {d.d_attr('x', 'rel')} AS rel
  FROM (SELECT url, unnest(regexp_extract_all(body, '(?is)<link\\s[^>]*>', 0)) AS x FROM feeds)) WHERE rel = 'alternate' and href <> '' and (type in {d.tags(L.FEED_TYPES)} or regexp_matches(href, 'atom|rss'))
UNION ALL SELECT url, href, 2 FROM (SELECT url, {d_unescape(d.d_attr('x', 'href'))} AS href FROM (SELECT url, unnest(regexp_extract_all(body, '(?is)<a\\s[^>]*>', 0)) AS x FROM feeds))
  WHERE regexp_matches(lower(href), '\\.(?:rss|rdf|xml|atom)$') or regexp_matches(href, 'atom|rss')""",
)
cte(
    "discovered",
    f"""SELECT DISTINCT url, feed FROM (SELECT url, {d_clean('r')} AS feed FROM (SELECT url, {d_resolve('b', 'href')} AS r FROM (SELECT n.url, href, {d_base('n.url')} AS b FROM feed_named n
  WHERE rank = (SELECT min(rank) FROM feed_named x WHERE x.url = n.url)))) WHERE feed <> url and {d_valid('feed')} and not regexp_matches(feed, '(^|[^A-Za-z0-9_])comments([^A-Za-z0-9_]|$)')""",
)


@query("discover_feeds", "G4", "SELECT * FROM discovered")
def q_discover_feeds(spark, sf_dir):
    return L.discover_feeds(feeds(spark, sf_dir))


cte("via_source", "SELECT s.url, b.body FROM discovered s JOIN feed_bodies b ON b.url = s.feed WHERE s.url not in (SELECT url FROM feed_refined)")
feed_link_cte("via_", "via_source")
cte(
    "via_flagged",
    f"""SELECT url, link, length(url) <= length({d_base('url')}) + 2 or starts_with(link, regexp_replace(url, '/+$', '')) or contains(link, url) AS hit,
  regexp_matches(link, '{urls.FEED_PROXY}') AS proxy FROM via_feed_refined""",
)


@query(
    "feed_search",
    "G5",
    """SELECT url, link FROM feed_refined UNION SELECT url, link FROM via_flagged f
WHERE hit or (proxy and not (SELECT bool_or(hit) FROM via_flagged x WHERE x.url = f.url))""",
)
def q_feed_search(spark, sf_dir):
    return L.feed_search(feeds(spark, sf_dir).select("url", "body"), load(spark, sf_dir, "feed_bodies"))


D_SITEMAP = f"not ((regexp_matches(regexp_replace(url, '[?#].*$', ''), '\\.xml([^A-Za-z0-9_]|$)') and not regexp_matches(body, '{L.SITEMAP_START}')) or contains(lower(substr(body, 1, 150)), '<html'))"
cte("sitemap_mix", "SELECT url, body FROM sitemaps UNION ALL SELECT url || '/sitemap.xml', html FROM pages")


def sitemap_mix(spark, sf_dir):
    s = load(spark, sf_dir, "sitemaps").select("url", "body")
    p = load(spark, sf_dir, "pages").select(F.concat("url", F.lit("/sitemap.xml")).alias("url"), F.col("html").alias("body"))
    return s.unionByName(p)


@query("sitemap_valid", "G6", f"SELECT url, cast({D_SITEMAP} as int) AS ok FROM sitemap_mix")
def q_sitemap_valid(spark, sf_dir):
    return sitemap_mix(spark, sf_dir).selectExpr("url", f"cast({L.sql_is_sitemap()} as int) AS ok")


cte(
    "sitemap_raw",
    f"""SELECT url, unnest(case when regexp_matches(body, '{L.SITEMAP_START}') then regexp_extract_all(body, '{L.LOC}', 1) else regexp_extract_all(body, '{L.PLAIN_LINK}', 0) end) AS link
FROM sitemap_mix WHERE {D_SITEMAP}""",
)


@query("sitemap_links", "G7", "SELECT * FROM sitemap_raw")
def q_sitemap_links(spark, sf_dir):
    return L.sitemap_links(sitemap_mix(spark, sf_dir))


cte(
    "lang_raw",
    f"""SELECT url, href AS link FROM (SELECT url, {d.d_attr('x', 'hreflang')} AS lang, {d.d_attr('x', 'href')} AS href FROM (
  SELECT url, unnest(regexp_extract_all(body, '{L.LANG_TAG}', 0)) AS x FROM sitemap_mix WHERE {D_SITEMAP})) WHERE (lang like 'de%' or lang = 'x-default') and href <> ''""",
)


@query("sitemap_lang_links", "G8", "SELECT url, link FROM lang_raw UNION ALL SELECT url, link FROM sitemap_raw WHERE url not in (SELECT url FROM lang_raw)")
def q_sitemap_lang_links(spark, sf_dir):
    return L.sitemap_lang_links(sitemap_mix(spark, sf_dir), "de")


D_OK = f"link <> url and {d_valid('full_link')} and ({d_domain(d_host('full_link'))} = {d_domain(d_host('url'))} or regexp_matches({d_host('full_link')}, '{urls.BLOG_PLATFORM}'))"


def state_cte(name: str, lang_ok: str) -> None:
    cte(
        name,
        f"""SELECT url, full_link AS link, case when not ({D_OK} and {lang_ok}) then 'rejected' when regexp_matches(full_link, '{L.SITEMAP_NAME}') then 'sitemap' else 'link' end AS state
FROM (SELECT url, link, {d_clean('r')} AS full_link FROM (SELECT url, link, {d_resolve('b', 'link')} AS r FROM (SELECT url, link, {d_base('url')} AS b FROM sitemap_raw)))""",
    )


state_cte("states_fr", f"coalesce({d_lang('full_link')} = 'fr', true)")
state_cte("states_any", "true")


@query("link_state", "G9", "SELECT * FROM states_fr")
def q_link_state(spark, sf_dir):
    return L.link_state(L.sitemap_links(sitemap_mix(spark, sf_dir)), "fr")


@query(
    "robots_sitemaps",
    "G10",
    f"""SELECT page_id, base_url, {d_resolve('base_url', 'v')} AS sitemap FROM (SELECT page_id, base_url, lower(trim(regexp_extract(line, '^([^:]*):', 1))) AS k, trim(regexp_extract(line, '^[^:]*:(.*)$', 1)) AS v
FROM (SELECT page_id, base_url, trim(regexp_replace(unnest(regexp_split_to_array(body, '\\r\\n|\\n|\\r')), '#.*$', '')) AS line FROM robots WHERE length(body) <= {L.MAX_ROBOTS})) WHERE k = 'sitemap'""",
)
def q_robots_sitemaps(spark, sf_dir):
    return L.robots_sitemaps(load(spark, sf_dir, "robots"))


@query(
    "guess_sitemaps",
    "G11",
    f"SELECT DISTINCT b AS base_url, b || '/' || g AS sitemap FROM (SELECT {d_base('url')} AS b, unnest(['sitemap.xml.gz', 'sitemap', 'sitemap_index.xml', 'sitemap_news.xml']) AS g FROM pages)",
)
def q_guess_sitemaps(spark, sf_dir):
    hosts = load(spark, sf_dir, "pages").select(urls.base_url(F.col("url")).alias("base_url")).distinct()
    return L.guess_sitemaps(hosts)


cte("search_mix", "SELECT url, body FROM sitemap_mix UNION ALL SELECT url, body FROM search_bodies")
cte(
    "search_raw",
    f"""SELECT url, unnest(case when regexp_matches(body, '{L.SITEMAP_START}') then regexp_extract_all(body, '{L.LOC}', 1) else regexp_extract_all(body, '{L.PLAIN_LINK}', 0) end) AS link
FROM search_mix WHERE {D_SITEMAP}""",
)
cte(
    "search_edges",
    f"""SELECT DISTINCT url, full_link AS link, case when regexp_matches(full_link, '{L.SITEMAP_NAME}') then 'sitemap' else 'link' end AS state
FROM (SELECT url, link, {d_clean('r')} AS full_link FROM (SELECT url, link, {d_resolve('b', 'link')} AS r FROM (SELECT url, link, {d_base('url')} AS b FROM search_raw))) WHERE {D_OK}""",
)
D_GIVEN = "regexp_matches(start, '(\\.xml|\\.gz|sitemap)$')"
cte(
    "search_seeds",
    f"""SELECT start, base, case when not {D_GIVEN} and length(start) > length(base) + 2 then start end AS pattern, case when {D_GIVEN} then start else base || '/sitemap.xml' end AS url
FROM (SELECT DISTINCT url AS start, {d_base('url')} AS base FROM search_starts)""",
)
cte(
    "search_robots",
    f"""SELECT DISTINCT base_url AS base, {d_resolve('base_url', 'v')} AS url FROM (SELECT base_url, lower(trim(regexp_extract(line, '^([^:]*):', 1))) AS k, trim(regexp_extract(line, '^[^:]*:(.*)$', 1)) AS v
FROM (SELECT base_url, trim(regexp_replace(unnest(regexp_split_to_array(body, '\\r\\n|\\n|\\r')), '#.*$', '')) AS line FROM robots WHERE length(body) <= {L.MAX_ROBOTS})) WHERE k = 'sitemap'""",
)
cte(
    "search_first",
    """SELECT start, pattern, url FROM search_seeds WHERE url in (SELECT url FROM search_edges)
UNION SELECT s.start, s.pattern, r.url FROM search_seeds s JOIN search_robots r ON r.base = s.base WHERE s.url not in (SELECT url FROM search_edges)
UNION SELECT start, pattern, base || '/' || g FROM (SELECT *, unnest(['sitemap.xml.gz', 'sitemap', 'sitemap_index.xml', 'sitemap_news.xml']) AS g FROM search_seeds
  WHERE url not in (SELECT url FROM search_edges) and base not in (SELECT base FROM search_robots))""",
)
cte("recursive_search", "SELECT start, pattern, url FROM search_first UNION SELECT w.start, w.pattern, e.link FROM recursive_search w JOIN search_edges e ON e.url = w.url WHERE e.state = 'sitemap'")


@query(
    "sitemap_search_full",
    "G12",
    f"""SELECT start, link FROM (SELECT *, max(hit) OVER (PARTITION BY start) AS any_hit FROM (SELECT DISTINCT w.start, e.link, case when w.pattern is null or contains(e.link, w.pattern) then 1 else 0 end AS hit
FROM recursive_search w JOIN search_edges e ON e.url = w.url WHERE e.state = 'link') WHERE hit = 1 or regexp_matches(link, '{urls.FEED_PROXY}')) WHERE hit = 1 or any_hit = 0""",
)
def q_sitemap_search_full(spark, sf_dir):
    bodies = sitemap_mix(spark, sf_dir).unionByName(load(spark, sf_dir, "search_bodies"))
    return L.search_sitemaps(load(spark, sf_dir, "search_starts"), bodies, load(spark, sf_dir, "robots"))


# Depth-wise walk; UNION keeps (url, depth) pairs apart, the least depth is taken after.
cte(
    "recursive_walk",
    """SELECT url, 0 AS depth FROM sitemaps WHERE url like '%/sitemap.xml'
UNION SELECT e.link, w.depth + 1 FROM recursive_walk w JOIN states_any e ON e.url = w.url WHERE e.state = 'sitemap' and w.depth < 6""",
)


@query("expand_sitemaps", "G12", "SELECT url, min(depth) AS depth FROM recursive_walk GROUP BY url")
def q_expand_sitemaps(spark, sf_dir):
    bodies = sitemap_mix(spark, sf_dir)
    seeds = load(spark, sf_dir, "sitemaps").where("url like '%/sitemap.xml'").select("url")
    return L.expand_sitemaps(seeds, L.sitemap_edges(bodies).persist())


@query(
    "sitemap_search",
    "G12",
    "SELECT DISTINCT url, link FROM states_any WHERE state = 'link' and url in (SELECT url FROM recursive_walk)",
)
def q_sitemap_search(spark, sf_dir):
    seeds = load(spark, sf_dir, "sitemaps").where("url like '%/sitemap.xml'").select("url")
    return L.sitemap_search(seeds, sitemap_mix(spark, sf_dir))
