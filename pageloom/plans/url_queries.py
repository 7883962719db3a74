"""Queries over the visit log and link columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions import domains, urls
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load


def d_scheme(u: str) -> str:
    return f"coalesce(nullif(lower(regexp_extract({u}, '{urls.SCHEME}', 1)), ''), 'http')"


def d_netloc(u: str) -> str:
    return f"regexp_extract({u}, '{urls.NETLOC}', 1)"


def d_host(u: str) -> str:
    return f"lower(regexp_extract({d_netloc(u)}, '{urls.HOST}', 1))"


def d_path(u: str) -> str:
    return f"regexp_extract({u}, '{urls.PATH}', 1)"


def d_query(u: str) -> str:
    return f"regexp_extract({u}, '{urls.QUERY}', 1)"


def d_drop(q: str, pattern: str) -> str:
    return f"array_to_string(list_filter(string_split({q}, '&'), lambda p: NOT regexp_matches(p, '{pattern}')), '&')"


def d_kind(h: str) -> str:
    return (
        f"case when {h} like '%youtube.com%' then 'youtube' when {h} like '%arxiv.com%' or {h} like '%arxiv.org%' then 'arxiv' "
        f"when {h} like '%github.io%' then 'github.io' when {h} like '%dataskeptic.com%' then 'dataskeptic' else 'other' end"
    )


def d_base(u: str) -> str:
    return f"{d_scheme(u)} || '://' || lower({d_netloc(u)})"


def d_clean(u: str) -> str:
    u = f"trim({u})"
    q = d_drop(d_query(u), urls.TRACKING_PARAM)
    return f"({d_base(u)} || regexp_replace({d_path(u)}, '/+$', '') || case when {q} = '' then '' else '?' || {q} end)"


PLAIN, WILD, BUT = (str(sorted(rules)) for rules in domains.parted(domains.RULES))


def d_domain(h: str) -> str:
    """All rules are tried on the end of the host, instead of its ends among the rules."""
    def longest(rules: str, fits: str) -> str:
        return f"list_max(list_transform(list_filter({rules}, lambda r: {fits}), lambda r: len(string_split(r, '.'))))"

    ends = f"ends_with('.' || {h}, '.' || r)"
    labels = (
        f"coalesce({longest(BUT, ends)}, 1 + greatest(1, coalesce({longest(PLAIN, ends)}, 1), coalesce(1 + {longest(WILD, f'{ends} and {h} <> r')}, 1)))"
    )
    return f"case when regexp_matches({h}, '{domains.ADDRESS}') then {h} else array_to_string(string_split({h}, '.')[-{labels}:], '.') end"


def d_valid(u: str) -> str:
    return f"regexp_matches({u}, '{urls.VALID_URL}')"


def d_lang(u: str) -> str:
    return (
        f"lower(coalesce(nullif(regexp_extract({d_path(u)}, '^/([A-Za-z]{{2}})(?:/|$)', 1), ''), "
        f"nullif(regexp_extract({d_query(u)}, '(?:^|&)(?:hl|lang)=([A-Za-z]{{2}})(?:[-_&]|$)', 1), '')))"
    )


def d_resolve(b: str, k: str) -> str:
    root = f"({d_scheme(b)} || '://' || {d_netloc(b)})"
    folder = f"(case when {d_path(b)} = '' then {root} || '/' else {root} || regexp_replace({d_path(b)}, '[^/]*$', '') end)"
    return f"""(case when trim({k}) = '' then {b}
      when regexp_matches(trim({k}), '{urls.SCHEME}') then trim({k})
      when starts_with(trim({k}), '//') then {d_scheme(b)} || ':' || trim({k})
      when starts_with(trim({k}), '/') then {root} || trim({k})
      when starts_with(trim({k}), '?') then {root} || {d_path(b)} || trim({k})
      when starts_with(trim({k}), '#') then regexp_replace({b}, '#.*$', '') || trim({k})
      else {folder} || regexp_replace(trim({k}), '^(\\./)+', '') end)"""


cte(
    "link_pairs",
    r"""
SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages
UNION ALL SELECT page_id, url, '' FROM pages
UNION ALL SELECT page_id, url, '//cdn.example.org/' || page_id || '.PNG' FROM pages
UNION ALL SELECT page_id, url, './x/' || page_id FROM pages
UNION ALL SELECT page_id, url, '?p=' || page_id FROM pages
UNION ALL SELECT page_id, url, '#a' FROM pages
UNION ALL SELECT page_id, url, ' https://Other.example.org/A/?utm_term=1&b=2#z ' FROM pages
UNION ALL SELECT page_id, url, 'https://feedproxy.example/' || page_id FROM pages
UNION ALL SELECT page_id, url, 'https://me.blogspot.com/' || page_id || '?hl=de' FROM pages
""",
)


def link_pairs(spark, sf_dir):
    """Link occurrences of each page plus one of every relative form."""
    pid = F.col("page_id").cast("string")
    forms = F.concat(
        F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)),
        F.array(
            F.lit(""),
            F.concat(F.lit("//cdn.example.org/"), pid, F.lit(".PNG")),
            F.concat(F.lit("./x/"), pid),
            F.concat(F.lit("?p="), pid),
            F.lit("#a"),
            F.lit(" https://Other.example.org/A/?utm_term=1&b=2#z "),
            F.concat(F.lit("https://feedproxy.example/"), pid),
            F.concat(F.lit("https://me.blogspot.com/"), pid, F.lit("?hl=de")),
        ),
    )
    return load(spark, sf_dir, "pages").select("page_id", "url", F.explode(forms).alias("link"))


@query(
    "url_parts",
    "B1",
    f"SELECT page_id, {d_scheme('url')} AS scheme, {d_netloc('url')} AS netloc, {d_host('url')} AS hostname, "
    f"{d_path('url')} AS path, {d_query('url')} AS query FROM visits",
)
def q_url_parts(spark, sf_dir):
    v = load(spark, sf_dir, "visits")
    return v.select("page_id", *[c.alias(n) for n, c in urls.url_parts(F.col("url")).items()])


@query(
    "strip_tracking",
    "B3",
    f"SELECT page_id, {d_drop(d_query('url'), urls.TRACKING_PARAM)} AS query FROM visits",
)
def q_strip_tracking(spark, sf_dir):
    v = load(spark, sf_dir, "visits")
    return v.select("page_id", urls.strip_tracking(urls.query_string(F.col("url"))).alias("query"))


@query(
    "strip_video_timestamp",
    "B4",
    f"SELECT page_id, case when {d_kind(d_host('url'))} = 'youtube' then {d_drop(d_query('url'), urls.VIDEO_TIME_PARAM)} "
    f"else {d_query('url')} end AS query FROM visits",
)
def q_strip_video_timestamp(spark, sf_dir):
    v = load(spark, sf_dir, "visits")
    u = F.col("url")
    return v.select(
        "page_id",
        urls.strip_video_timestamp(urls.query_string(u), urls.url_kind(urls.hostname(u))).alias("query"),
    )


@query("url_kind", "B5", f"SELECT page_id, {d_kind(d_host('url'))} AS kind FROM visits")
def q_url_kind(spark, sf_dir):
    v = load(spark, sf_dir, "visits")
    return v.select("page_id", urls.url_kind(urls.hostname(F.col("url"))).alias("kind"))


@query("url_digest", "B6", "SELECT page_id, md5(url) AS digest FROM visits")
def q_url_digest(spark, sf_dir):
    return load(spark, sf_dir, "visits").select("page_id", urls.url_digest(F.col("url")).alias("digest"))


@query(
    "resolve_url",
    "B7",
    f"SELECT page_id, link, {d_resolve('url', 'link')} AS resolved FROM link_pairs",
)
def q_resolve_url(spark, sf_dir):
    df = link_pairs(spark, sf_dir)
    return df.select("page_id", "link", urls.resolve_url(F.col("url"), F.col("link")).alias("resolved"))


@query("clean_url", "B8", f"SELECT page_id, {d_clean('url')} AS cleaned FROM visits")
def q_clean_url(spark, sf_dir):
    return load(spark, sf_dir, "visits").select("page_id", urls.clean_url(F.col("url")).alias("cleaned"))


@query(
    "valid_url",
    "B9",
    f"SELECT page_id, link, cast({d_valid('trim(link)')} as int) AS valid, cast({d_valid('trim(link)')} and not "
    f"regexp_matches({d_path('trim(link)')}, '{urls.ASSET_FILE}') and not regexp_matches({d_path('trim(link)')}, '{urls.IMAGE_FILE}') as int) AS page FROM link_pairs",
)
def q_valid_url(spark, sf_dir):
    u = F.trim("link")
    return link_pairs(spark, sf_dir).select(
        "page_id", "link", urls.is_valid_url(u).cast("int").alias("valid"), urls.is_page_url(u).cast("int").alias("page")
    )


@query(
    "host_info",
    "B10",
    f"SELECT page_id, {d_domain(d_host('url'))} AS domain, {d_base('url')} AS base_url FROM visits",
)
def q_host_info(spark, sf_dir):
    v = load(spark, sf_dir, "visits")
    return v.select("page_id", *[c.alias(n) for n, c in urls.host_info(F.col("url")).items()])


@query(
    "url_language",
    "B11",
    f"SELECT page_id, link, {d_lang('link')} AS lang, cast(coalesce({d_lang('link')} = 'en', true) as int) AS ok FROM "
    "(SELECT page_id, link FROM link_pairs UNION ALL SELECT page_id, url FROM pages)",
)
def q_url_language(spark, sf_dir):
    df = link_pairs(spark, sf_dir).select("page_id", "link")
    df = df.unionByName(load(spark, sf_dir, "pages").select("page_id", F.col("url").alias("link")))
    return df.select(
        "page_id",
        "link",
        urls.url_language(F.col("link")).alias("lang"),
        urls.url_lang_ok(F.col("link"), "en").cast("int").alias("ok"),
    )


@query(
    "filter_urls",
    "B12",
    """
SELECT list_id, url FROM (
  SELECT DISTINCT page_id AS list_id, link AS url, contains(link, '/th') AS hit,
    max(contains(link, '/th')) OVER (PARTITION BY page_id) AS any_hit FROM link_pairs)
WHERE hit OR (NOT any_hit AND regexp_matches(url, 'feedburner|feedproxy'))
""",
)
def q_filter_urls(spark, sf_dir):
    df = link_pairs(spark, sf_dir).select(F.col("page_id").alias("list_id"), F.col("link").alias("url"))
    return urls.filter_urls(df, "/th")


@query(
    "same_domain",
    "B13",
    f"SELECT page_id, r AS link FROM (SELECT page_id, url, {d_resolve('url', 'link')} AS r FROM link_pairs) "
    f"WHERE {d_domain(d_host('r'))} = {d_domain(d_host('url'))} OR regexp_matches({d_host('r')}, '{urls.BLOG_PLATFORM}')",
)
def q_same_domain(spark, sf_dir):
    df = link_pairs(spark, sf_dir).select(
        "page_id", "url", urls.resolve_url(F.col("url"), F.col("link")).alias("link")
    )
    domain = urls.domain_of_host(urls.hostname(F.col("url")))
    return df.where(urls.same_domain(F.col("link"), domain)).select("page_id", "link")


@query(
    "image_file",
    "B14",
    f"SELECT page_id, link, cast(regexp_matches(lower(link), '{urls.IMAGE_FILE}') as int) AS image FROM link_pairs",
)
def q_image_file(spark, sf_dir):
    return link_pairs(spark, sf_dir).select(
        "page_id", "link", urls.is_image(F.lower("link")).cast("int").alias("image")
    )


HOSTS = """case page_id % 9 when 0 then 'a.b.co.uk' when 1 then 'co.uk' when 2 then concat('www.x', cast(page_id as string), '.com.au') when 3 then 'deep.a.other.ck'
  when 4 then 'www.ck' when 5 then 'city.kawasaki.jp' when 6 then 'h.any.kawasaki.jp' when 7 then '192.168.0.7' else concat('n', cast(page_id as string), '.example.org') end"""


@query("registered_domain", "B10", f"SELECT page_id, host, {d_domain('host')} AS domain, {d_domain('host')} AS by_table FROM (SELECT page_id, {HOSTS} AS host FROM pages)")
def q_registered_domain(spark, sf_dir):
    """By the list of rules in the plan, and by the same rules as a table."""
    hosts = load(spark, sf_dir, "pages").selectExpr("page_id", f"{HOSTS} AS host")
    rules = spark.createDataFrame([(r,) for r in domains.RULES], "rule string")
    by_table = domains.registered_domains(hosts, rules).withColumnRenamed("domain", "by_table")
    return hosts.withColumn("domain", domains.domain_of_host(F.col("host"))).join(by_table, "host").select("page_id", "host", "domain", "by_table")
