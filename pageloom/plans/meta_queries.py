"""Queries over page metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import jsonld, markup, metadata, prune
from pageloom.plans import markup_sql as d
from pageloom.plans import page_meta as pm
from pageloom.plans.markup_queries import rich, rich_blocks
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load
from pageloom.plans.text_queries import d_trim_ws, d_unescape
from pageloom.functions import text as tx
from pageloom.functions import urls

M = metadata
D_HEAD = f"regexp_extract({d.d_strip_noise('html')}, '{M.HEAD}', 1)"


def head_ctes(prefix: str, source: str) -> None:
    cte(
        f"{prefix}head_tags",
        f"""SELECT page_id, n, lower(regexp_extract(x, '^<([A-Za-z]+)', 1)) AS tag, {d.d_attr('x', 'property')} AS prop, lower({d.d_attr('x', 'name')}) AS name,
  {d.d_attr('x', 'itemprop')} AS itemprop, {d.d_attr('x', 'rel')} AS rel, {d.d_attr('x', 'type')} AS type, {d.d_attr('x', 'hreflang')} AS hreflang,
  {d_unescape(d.d_attr('x', 'href'))} AS href, regexp_replace({d_unescape(d.d_attr('x', 'content'))}, '{d.m.ANY_TAG}', '', 'g') AS content
FROM (SELECT page_id, unnest(t) AS x, generate_subscripts(t, 1) - 1 AS n FROM (SELECT page_id, regexp_extract_all({D_HEAD}, '{M.HEAD_TAG}', 0) AS t FROM {source}))""",
    )


head_ctes("", "rich_pages")
head_ctes("video_", "video_pages")


def d_pick(cond: str, last: bool = False, field: str = "content", source: str = "head_tags") -> str:
    agg = "arg_max" if last else "arg_min"
    return f"(SELECT {agg}(m.{field}, m.n) FROM {source} m WHERE m.page_id = p.page_id and m.{field} <> '' and ({cond}))"


@query("meta_rows", "E1", "SELECT * FROM head_tags")
def q_meta_rows(spark, sf_dir):
    return M.meta_rows(rich(spark, sf_dir))


OG = {
    "og_title": d_pick("m.prop = 'og:title' or m.name = 'og:title'", True),
    "og_author": d_pick("m.prop in ('og:author', 'og:article:author')", True),
    "og_url": d_pick(f"m.prop = 'og:url' and regexp_matches(m.content, '{urls.VALID_URL}')", True),
    "og_description": d_pick("m.prop = 'og:description'", True),
    "og_site": d_pick("m.prop = 'og:site_name'", True),
}
cte(
    "og_fields",
    f"""SELECT *, og_title is not null and og_author is not null and og_url is not null and og_description is not null and og_site is not null AS og_complete
FROM (SELECT p.page_id, {', '.join(f'{e} AS {n}' for n, e in OG.items())} FROM rich_pages p)""",
)


@query("opengraph", "E2", f"SELECT page_id, {', '.join(OG)}, cast(og_complete as int) AS og_complete FROM og_fields")
def q_opengraph(spark, sf_dir):
    df = M.opengraph(M.with_head(rich(spark, sf_dir)))
    return df.select("page_id", *OG, F.col("og_complete").cast("int").alias("og_complete"))


def d_names(field: str) -> str:
    return f"(m.prop = '' and m.name in {d.tags(M.META_FIELDS[field])})"


def d_normalize_authors(candidates: str, start: str = "[]::varchar[]") -> str:
    clean = "trim(a)"
    for pattern, new in M.AUTHOR_STEPS:
        clean = f"regexp_replace({clean}, '{pattern}', '{new}', 'g')"
    split = (
        f"flatten(list_transform(list_filter({candidates}, lambda a: not regexp_matches(a, '{M.AUTHOR_SKIP}')), "
        f"lambda a: regexp_split_to_array({d_unescape('a')}, '{M.AUTHOR_SPLIT}')))"
    )
    names = (
        f"list_filter(list_transform({split}, lambda a: {clean}), lambda a: a <> '' and (contains(a, ' ') or contains(a, '-') or length(a) < 50))"
    )
    words = "array_to_string(list_transform(string_split(p, ' '), lambda w: case when w[1] = 'ß' then 'Ss' else upper(w[1]) end || lower(w[2:])), ' ')"
    cased = (
        f"list_transform({names}, lambda a: case when regexp_matches(a, '^[^A-ZÄÖÜÉÈÁÍÓÚÑÇ]') then "
        f"array_to_string(list_transform(string_split(a, '-'), lambda p: {words}), '-') else a end)"
    )
    new = "list_filter(n.all, lambda a, i: len(list_filter(n.all[1:i - 1], lambda b: contains(a, b))) = 0)"
    return f"(SELECT nullif(array_to_string({new}, '; '), '') FROM (SELECT list_concat({start}, {cased}) AS all) n)"


def d_tags(c: str) -> str:
    plain = f"regexp_replace({d_trim_ws(d_unescape(c))}, '[\\x22\\x27]', '', 'g')"
    return f"array_to_string(list_filter(string_split({plain}, ', '), lambda t: t <> ''), ', ')"


AUTHOR_TAG = f"m.prop in ('author', 'article:author') or {d_names('author')} or (m.prop = '' and m.name = '' and m.itemprop = 'author')"
TITLED = f"{d_names('title')} or (m.prop = '' and m.name = '' and m.itemprop = 'headline')"
DESCRIBED = f"{d_names('description')} or (m.prop = '' and m.name = '' and m.itemprop = 'description')"
PUBLISHED = f"m.prop = 'article:publisher' or {d_names('publisher')}"
BACKUP = f"m.prop = '' and (m.name in {d.tags(M.META_FIELDS['site'])} or contains(m.name, 'twitter:app:name'))"
cte(
    "meta_found",
    f"""SELECT page_id, case when og_complete then og_title else coalesce(og_title, t) end AS meta_title,
  case when og_complete then og_author else {d_normalize_authors('names', "case when og_author is null then []::varchar[] else [og_author] end")} end AS meta_author,
  case when og_complete then og_url else coalesce(og_url, u) end AS meta_url,
  case when og_complete then og_description else coalesce(og_description, de) end AS meta_description,
  case when og_complete then og_site else coalesce(og_site, pu, ba) end AS meta_site,
  case when og_complete then '' else coalesce(tags, '') end AS meta_tags
FROM (SELECT p.*, {d_pick(TITLED)} AS t, {d_pick(f"m.prop = '' and m.name = 'twitter:url' and regexp_matches(m.content, '{urls.VALID_URL}')")} AS u, {d_pick(DESCRIBED)} AS de,
  {d_pick(PUBLISHED)} AS pu, {d_pick(BACKUP, True)} AS ba,
  coalesce((SELECT list(m.content ORDER BY m.n) FROM head_tags m WHERE m.page_id = p.page_id and m.content <> '' and ({AUTHOR_TAG})), []) AS names,
  (SELECT string_agg({d_tags('m.content')}, '|' ORDER BY m.n) FROM head_tags m WHERE m.page_id = p.page_id and m.content <> '' and (m.prop = 'article:tag' or {d_names('tag')}) and {d_tags('m.content')} <> '') AS tags
  FROM og_fields p)""",
)


@query("meta_fields", "E3", "SELECT * FROM meta_found")
def q_meta_fields(spark, sf_dir):
    df = M.meta_fields(M.with_head(rich(spark, sf_dir)))
    return df.select(
        "page_id", "meta_title", "meta_author", "meta_url", "meta_description", "meta_site",
        F.array_join("meta_tags", "|").alias("meta_tags"),
    )


def j(path: str, v: str = "m") -> str:
    return f"json_extract_string({v}, '{path}')"


def d_list(v: str, path: str) -> str:
    return f"(case when json_extract({v}, '{path}') is null then [] when json_type({v}, '{path}') = 'ARRAY' then json_extract({v}, '{path}[*]') else [json_extract({v}, '{path}')] end)"


A_NAME = (
    "case when coalesce(json_extract_string(a, '$.\"@type\"'), 'Person') = 'Person' then coalesce(case when json_type(a, '$.name') = 'ARRAY' then "
    "array_to_string(json_extract_string(a, '$.name[*]'), '; ') else json_extract_string(a, '$.name') end, "
    "nullif(concat_ws(' ', json_extract_string(a, '$.givenName'), json_extract_string(a, '$.additionalName'), json_extract_string(a, '$.familyName')), '')) end"
)
G, C, T = '$."@graph"', '$."@context"', '$."@type"'
LIVE = f"(coalesce(lower(json_extract_string(p, '{T}')), '') like '%liveblogposting%' and json_extract(p, '$.liveBlogUpdate') is not null)"
GRAPH = f"json_extract(p, '{G}') is not null"


def ld_ctes(prefix: str, source: str) -> None:
    cte(
        f"{prefix}ld_members",
        f"""SELECT page_id, unnest(members) AS m, generate_subscripts(members, 1) - 1 AS n FROM (
  SELECT page_id, list_concat(flatten(list_transform(parents, lambda p: case when {GRAPH} then {d_list('p', G)} when {LIVE} then {d_list('p', '$.liveBlogUpdate')} else [] end)),
    case when len(list_filter(parents, lambda p: not ({GRAPH}) and not {LIVE})) > 0 then items else [] end) AS members FROM (
  SELECT *, list_filter(items, lambda p: regexp_matches(coalesce(json_extract_string(p, '{C}'), ''), '(?i)schema\\.org/?$')) AS parents FROM (
  SELECT page_id, {d_list('doc', '$')} AS items FROM (SELECT page_id, try_cast(js as json) AS doc FROM {source} WHERE json_valid(js)))))""",
    )
    cte(
        f"{prefix}ld_rows",
        f"""SELECT page_id, n, lower(case when json_type(m, '{T}') = 'ARRAY' then json_extract_string(m, '{T}[0]') else json_extract_string(m, '{T}') end) AS type,
  {j('$.name')} AS name, {j('$.alternateName')} AS alternate, {j('$.headline')} AS headline, {j('$.publisher.name')} AS publisher,
  case when json_type(m, '$.articleSection') = 'ARRAY' then array_to_string(json_extract_string(m, '$.articleSection[*]'), ';') else {j('$.articleSection')} end AS section,
  list_filter(list_transform({d_list('m', '$.author')}, lambda a: {A_NAME}), lambda a: a is not null) AS authors, {j('$.datePublished')} AS published FROM {prefix}ld_members""",
    )


ld_ctes("", "jsonld_source")


@query(
    "jsonld_rows",
    "E4",
    "SELECT page_id, n, type, name, alternate, headline, publisher, section, array_to_string(authors, '|') AS authors FROM ld_rows",
)
def q_jsonld_rows(spark, sf_dir):
    df = jsonld.jsonld_rows(load(spark, sf_dir, "jsonld_source"))
    return df.withColumn("authors", F.array_join("authors", "|")).drop("published")


ART = d.tags(jsonld.ARTICLE_TYPES)
PUB = d.tags(jsonld.PUBLISHER_TYPES)
# Every derived page has one publisher, or one site with a URL as name, or one graph.
cte(
    "ld_found",
    f"""SELECT page_id, coalesce(max(publisher), max(case when type in {PUB} then case when name like 'http%' and alternate is not null then alternate else name end end)) AS ld_site,
  coalesce(list(x ORDER BY n, k) FILTER (x is not null), []) AS names, arg_min(section, n) FILTER (section is not null and type in {ART}) AS ld_section,
  arg_min(title, n) FILTER (title is not null and type in {ART}) AS ld_title
FROM (SELECT *, case when type = 'article' and name is not null then name else headline end AS title,
  unnest(case when type = 'person' then [name] when type in {ART} and len(authors) > 0 then authors else [null] end) AS x,
  unnest(range(1, 1 + case when type in {ART} and len(authors) > 0 then len(authors) else 1 end)) AS k FROM ld_rows) GROUP BY page_id""",
)


@query(
    "jsonld_fields",
    "E5",
    f"SELECT page_id, ld_site, {d_normalize_authors('names')} AS ld_author, ld_section, ld_title FROM ld_found",
)
def q_jsonld_fields(spark, sf_dir):
    df = jsonld.jsonld_members(load(spark, sf_dir, "jsonld_source")).where("members is not null")
    df = jsonld.with_authors(jsonld.jsonld_fields(df))
    return df.select("page_id", "ld_site", "ld_author", "ld_section", "ld_title")


def d_value(key: str) -> str:
    return f"nullif(regexp_extract(js, '{jsonld.text_member(key)}', 1), '')"


def d_inside(key: str) -> str:
    return f"nullif(regexp_extract(js, '{jsonld.named_member(key)}', 1), '')"


@query(
    "jsonld_salvage",
    "E6",
    f"""SELECT page_id, {d_value('headline')} AS title, case when contains({d_inside('author')}, ' ') then {d_normalize_authors('[' + d_inside('author') + ']')} end AS author,
case when not contains({d_inside('publisher')}, ',') then {d_inside('publisher')} end AS sitename, {d_value('articleSection')} AS section FROM jsonld_source WHERE not json_valid(js)""",
)
def q_jsonld_salvage(spark, sf_dir):
    return jsonld.jsonld_salvage(load(spark, sf_dir, "jsonld_source"))


D_TITLE_TAG = f"nullif({d.d_trim_ws(d_unescape(f'''regexp_extract({D_HEAD}, '{M.TITLE_TAG}', 1)'''))}, '')"
# Titles with a site part, as pages of named sites have.
cte(
    "titles",
    f"""SELECT page_id, title_tag, nullif(regexp_extract(title_tag, '{M.TITLE_SPLIT}', 1), '') AS title_first, nullif(regexp_extract(title_tag, '{M.TITLE_SPLIT}', 2), '') AS title_second
FROM (SELECT page_id, {D_TITLE_TAG} || case page_id % 3 when 0 then '' when 1 then ' - Site.org' else ' | News' end AS title_tag FROM rich_pages)""",
)
cte(
    "headings",
    """SELECT p.page_id, coalesce(n_h1, 0) AS n_h1, first_h1, first_h2, classed, article_p, first_p, article_h1 FROM (SELECT DISTINCT page_id FROM blk) p LEFT JOIN (
SELECT page_id, count_if(tag = 'h1') AS n_h1, arg_min(text, pos) FILTER (tag = 'h1') AS first_h1, arg_min(text, pos) FILTER (tag = 'h2') AS first_h2,
  arg_min(text, pos) FILTER (tag in ('h1', 'h2', 'h3') and contains(cls, 'title') and text_len between 3 and 199) AS classed,
  arg_min(text, pos) FILTER (tag = 'p' and text_len > 0 and in_article > 0) AS article_p, arg_min(text, pos) FILTER (tag = 'p' and text_len > 0) AS first_p,
  arg_min(text, pos) FILTER (tag = 'h1' and in_article > 0 and text_len > 0) AS article_h1 FROM blk WHERE not closing GROUP BY page_id) h ON h.page_id = p.page_id""",
)
D_TITLE = """case when n_h1 = 1 and first_h1 <> '' then first_h1 when classed is not null then classed when title_first is not null and not contains(title_first, '.') then title_first
when title_second is not null and not contains(title_second, '.') then title_second when n_h1 > 0 then first_h1 when first_h2 is not null then first_h2 else title_tag end"""


def titled(spark, sf_dir):
    df = M.with_head(rich(spark, sf_dir)).withColumn(
        "title_tag", F.expr("concat(title_tag, case page_id % 3 when 0 then '' when 1 then ' - Site.org' else ' | News' end)")
    )
    return M.title_parts(df)


@query("page_title", "E7", f"SELECT h.page_id, {D_TITLE} AS title FROM headings h JOIN titles t ON t.page_id = h.page_id")
def q_page_title(spark, sf_dir):
    heads = M.heading_fields(rich_blocks(spark, sf_dir))
    return heads.join(titled(spark, sf_dir), "page_id").selectExpr("page_id", f"{M.SQL_TITLE} AS title")


@query(
    "title_parts",
    "E8",
    "SELECT page_id, title_first, title_second, case when contains(title_first, '.') then title_first when contains(title_second, '.') then title_second end AS title_site FROM titles",
)
def q_title_parts(spark, sf_dir):
    return titled(spark, sf_dir).select("page_id", "title_first", "title_second", "title_site")


def d_first(*cols: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(trim({c}), '')" for c in cols) + ")"


@query(
    "simple_title_description",
    "E9",
    f"""SELECT p.page_id, {d_first(d_pick("m.prop = 'og:title' or m.name = 'og:title'"), d_pick("m.name = 'twitter:title'"), d_pick("m.tag = 'meta' and m.itemprop = 'name'"), 'article_h1', D_TITLE_TAG)} AS title,
{d_first(d_pick("m.prop = 'og:description' or m.name = 'og:description'"), d_pick("m.name = 'twitter:description'"), d_pick("m.itemprop = 'description'"), d_pick("m.name = 'description'"), 'article_p', 'first_p')} AS description
FROM rich_pages p JOIN headings h ON h.page_id = p.page_id""",
)
def q_simple_title_description(spark, sf_dir):
    heads = M.heading_fields(rich_blocks(spark, sf_dir))
    df = heads.join(M.with_head(rich(spark, sf_dir)), "page_id")
    return df.selectExpr("page_id", f"{M.sql_simple_title()} AS title", f"{M.sql_simple_description()} AS description")


D_IMG = f"nullif({d.d_attr(f'''regexp_extract({d.d_strip_noise('html')}, '{M.IMG_WITH_SRC}', 0)''', 'src')}, '')"
D_IMAGE = d_first(
    d_pick("m.prop = 'og:image'"), d_pick("m.name = 'twitter:image'"), d_pick("m.itemprop = 'image'"),
    d_pick("m.tag = 'link' and m.rel = 'icon'", field="href"), D_IMG,
)


@query("lead_image", "E10", f"SELECT p.page_id, case when length({D_IMAGE}) <= 1000 then {D_IMAGE} end AS image FROM rich_pages p")
def q_lead_image(spark, sf_dir):
    return M.lead_image(M.with_head(rich(spark, sf_dir))).select("page_id", "image")


def d_anchors(where: str) -> str:
    lead = "regexp_extract(a, '^<[^>]*>', 0)"
    return f"""(SELECT *, {d.d_attr(lead, 'href')} AS href, {d.d_attr(lead, 'rel')} AS rel, {d.d_trim_ws(d_unescape(f"regexp_replace(a, '{d.m.ANY_TAG}', '', 'g')"))} AS label
FROM (SELECT *, unnest(t) AS a, generate_subscripts(t, 1) - 1 AS n FROM (SELECT *, regexp_extract_all(flow, '{M.ANCHOR}', 0) AS t FROM blk WHERE {where})) WHERE {d.d_attr(lead, 'href')} <> '')"""


cte(
    "found_authors",
    f"""SELECT * FROM (SELECT page_id, {d_normalize_authors('[name]')} AS author FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY rank, pos, n) AS rn FROM (
  SELECT page_id, 1 AS rank, pos, n, label AS name FROM {d_anchors('in_byline_noise = 0')} WHERE rel = 'author'
  UNION ALL SELECT page_id, case when regexp_matches(cls, '(^|[\\s_-])author([\\s_-]|$)') then 2 when regexp_matches(cls, 'byline') then 3 when regexp_matches(cls, 'writer|contributor') then 4
    when regexp_matches(open_tag, '(?i)itemprop\\s*=\\s*.?author') then 5 when tag = 'address' then 6 end AS rank, pos, 0, text FROM blk WHERE in_byline_noise = 0 and not closing)
  WHERE rank is not null and length(name) between 3 and 119) WHERE rn = 1) WHERE author is not null""",
)


@query("page_author", "E11", "SELECT * FROM found_authors")
def q_page_author(spark, sf_dir):
    return M.page_author(rich_blocks(spark, sf_dir, "byline_noise"))


AUTHORS = """concat('By ', source, ' Smith, jane ', lang, '-Lee & @handle and Max "Mad" Muster 3rd | ', substr(text, 1, 30), '; x@y.org/Dr. Who from Here')"""


@query("normalize_authors", "E12", f"SELECT doc_id, {d_normalize_authors(f'[{AUTHORS}]')} AS authors FROM documents")
def q_normalize_authors(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").selectExpr("doc_id", f"{AUTHORS} AS names")
    return M.normalize_authors(docs, "names").select("doc_id", "authors")


USABLE = "regexp_matches(m.href, '^(https?://|/)')"
D_FOUND = f"""coalesce({d_pick(f"m.rel = 'canonical' and {USABLE}", field='href')}, {d_pick(f"m.rel = 'alternate' and m.hreflang = 'x-default' and {USABLE}", True, 'href')}, url)"""
D_SITE = f"""nullif(regexp_extract({d_pick("(m.name like 'og:%' or m.name like 'twitter:%' or m.prop like 'og:%' or m.prop like 'twitter:%') and regexp_matches(m.content, '^https?://[^/]+')")}, '^https?://[^/]+', 0), '')"""
cte(
    "canonicals",
    f"""SELECT page_id, case when regexp_matches(full_url, '{urls.VALID_URL}') then full_url end AS canonical FROM (
SELECT page_id, case when starts_with(found, '/') then coalesce(site || found, found) else found end AS full_url FROM (SELECT p.page_id, {D_FOUND} AS found, {D_SITE} AS site FROM rich_pages p))""",
)


@query("canonical_url", "E13", "SELECT * FROM canonicals")
def q_canonical_url(spark, sf_dir):
    return M.canonical_url(M.with_head(rich(spark, sf_dir))).select("page_id", "canonical")


@query(
    "site_name",
    "E14",
    """SELECT page_id, case when site is null then nullif(regexp_extract(url, '^https?://(?:www[.]|w[0-9]+[.])?([^/]+)', 1), '') when not contains(regexp_replace(site, '^@', ''), '.') and
  regexp_matches(regexp_replace(site, '^@', ''), '^[^A-ZÄÖÜ]') then array_to_string(list_transform(string_split(regexp_replace(site, '^@', ''), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
  else regexp_replace(site, '^@', '') end AS sitename
FROM (SELECT page_id, url, case page_id % 4 when 0 then '@daily news' when 1 then 'x.org' when 2 then 'The Post' end AS site FROM pages)""",
)
def q_site_name(spark, sf_dir):
    df = load(spark, sf_dir, "pages").selectExpr(
        "page_id", "url", "case page_id % 4 when 0 then '@daily news' when 1 then 'x.org' when 2 then 'The Post' end AS site"
    )
    return M.site_name(df).select("page_id", "sitename")


cte(
    "found_topics",
    f"""SELECT page_id, coalesce(string_agg(label, '|' ORDER BY pos, n) FILTER (regexp_matches(href, '/categor(?:y|ies|ys)/')), '') AS categories,
coalesce(string_agg(label, '|' ORDER BY pos, n) FILTER (regexp_matches(href, '/tags?/')), '') AS tags FROM {d_anchors('in_topics > 0')} WHERE label <> '' GROUP BY page_id""",
)


@query("categories_tags", "E15", "SELECT * FROM found_topics")
def q_categories_tags(spark, sf_dir):
    df = M.cats_tags(rich_blocks(spark, sf_dir, "topics"))
    return df.select("page_id", F.array_join("categories", "|").alias("categories"), F.array_join("tags", "|").alias("tags"))


D_CC = f"case when regexp_matches(href, '{M.LICENSE_PATH}') then 'CC ' || upper(regexp_extract(href, '{M.LICENSE_PATH}', 1)) || ' ' || regexp_extract(href, '{M.LICENSE_PATH}', 2) end"


cte(
    "found_licenses",
    f"""SELECT page_id, coalesce(s, w) AS license FROM (SELECT page_id, arg_min(case when rel = 'license' then coalesce({D_CC}, nullif(label, '')) end, pos * 1000 + n) AS s,
arg_min(case when in_footer > 0 or in_footer_named > 0 then coalesce({D_CC}, nullif(regexp_extract(label, '{M.LICENSE_TEXT}', 1), '')) end, pos * 1000 + n) AS w
FROM {d_anchors('true')} GROUP BY page_id) WHERE coalesce(s, w) is not null""",
)


@query("page_license", "E16", "SELECT * FROM found_licenses")
def q_page_license(spark, sf_dir):
    return M.page_license(rich_blocks(spark, sf_dir, "footer_named"))


DATED = "case page_id % 2 when 0 then url else concat('https://x.example.org/2021/', cast(1 + page_id % 13 as string), '/07/p') end"
PUB_META = "m.prop in ('article:published_time', 'og:published_time') or m.name in ('date', 'dc.date', 'dcterms.created', 'pubdate', 'citation_publication_date') or m.itemprop = 'datePublished'"


@query(
    "page_date",
    "E17",
    f"""SELECT page_id, coalesce(cast(try_cast(regexp_extract(meta, '{M.ISO_DATE}', 1) as date) as varchar), case when regexp_matches(u, '{M.URL_DATE}') then
  cast(try_cast(regexp_extract(u, '{M.URL_DATE}', 1) || '-' || lpad(regexp_extract(u, '{M.URL_DATE}', 2), 2, '0') || '-' || lpad(regexp_extract(u, '{M.URL_DATE}', 3), 2, '0') as date) as varchar) end) AS date
FROM (SELECT p.page_id, {DATED} AS u, case when page_id % 3 = 0 then {d_pick(PUB_META)} end AS meta FROM rich_pages p)""",
)
def q_page_date(spark, sf_dir):
    df = M.with_head(rich(spark, sf_dir)).withColumn("url", F.expr(DATED))
    df = df.withColumn("metas", F.expr("case when page_id % 3 = 0 then metas else filter(metas, m -> false) end"))
    return M.page_date(df).select("page_id", "date")


@query("normalize_tags", "E18", f"SELECT doc_id, {d_tags(chr(39) + chr(34) + 'a' + chr(34) + ', ' + chr(39) + ' || source || ' + chr(39) + ', , ' + chr(39) + ' || text')} AS tags FROM documents")
def q_normalize_tags(spark, sf_dir):
    raw = F.concat(F.lit('"a", '), F.col("source"), F.lit(", , "), F.col("text"))
    return load(spark, sf_dir, "documents").select("doc_id", tx.normalize_tags(raw).alias("tags"))


def v(name: str, field: str = "content") -> str:
    return d_pick(f"m.itemprop = '{name}'", field=field, source="video_head_tags")


def d_duration(c: str) -> str:
    part = [f"coalesce(try_cast(nullif(regexp_extract({c}, '{M.DURATION}', {g}), '') as bigint), 0)" for g in (1, 2, 3)]
    return f"case when regexp_matches({c}, '{M.DURATION}') and regexp_matches({c}, '[0-9]') then {part[0]} * 3600 + {part[1]} * 60 + {part[2]} end"


def d_joined(c: str) -> str:
    return f"array_to_string(list_transform(string_split({c}, ','), lambda t: trim(t)), '|')"


D_SPAN = f"regexp_extract(html, '{M.AUTHOR_SPAN}', 1)"
D_CHANNEL = d.d_attr(f"regexp_extract({D_SPAN}, '{M.URL_LINK}', 0)", "href")


@query(
    "video_page",
    "E19",
    f"""SELECT p.page_id, {v('name')} AS title, {d_duration(v('duration'))} AS duration, {v('datePublished')} AS date, {v('thumbnailUrl', 'href')} AS image, {D_CHANNEL} AS author,
{d_joined(d_pick("m.name = 'keywords'", source='video_head_tags'))} AS tags, {d_joined(v('genre'))} AS categories FROM video_pages p""",
)
def q_video_page(spark, sf_dir):
    df = M.video_page(load(spark, sf_dir, "video_pages"))
    return df.withColumns({c: F.array_join(c, "|") for c in ("tags", "categories")})


ISO = "case page_id % 5 when 0 then concat('PT', cast(page_id as string), 'S') when 1 then concat('PT1H', cast(page_id % 60 as string), 'M') when 2 then 'PT' when 3 then concat('PT2H3M', cast(page_id % 60 as string), 'S') else 'bad' end"


@query("duration_seconds", "E20", f"SELECT page_id, {d_duration('c')} AS seconds FROM (SELECT page_id, {ISO} AS c FROM pages)")
def q_duration_seconds(spark, sf_dir):
    df = load(spark, sf_dir, "pages").selectExpr("page_id", f"{ISO} AS c")
    return df.selectExpr("page_id", f"{M.sql_duration('c')} AS seconds")


# Whole records: the parts above put together by precedence, with subqueries per field instead of arrays on the row.
ld_ctes("rich_", f"(SELECT page_id, nullif(regexp_extract(html, '{jsonld.LD_SCRIPT}', 1), '') AS js FROM rich_pages)")
cte(
    "rich_titles",
    f"""SELECT page_id, title_tag, nullif(regexp_extract(title_tag, '{M.TITLE_SPLIT}', 1), '') AS title_first, nullif(regexp_extract(title_tag, '{M.TITLE_SPLIT}', 2), '') AS title_second
FROM (SELECT page_id, {D_TITLE_TAG} AS title_tag FROM rich_pages)""",
)
cte(
    "rich_ld",
    f"""SELECT page_id, arg_max(publisher, n) FILTER (publisher is not null) AS publisher, arg_min(section, n) FILTER (section is not null and type in {ART}) AS ld_section,
  arg_min(headline, n) FILTER (headline is not null and type in {ART}) AS ld_title, coalesce(flatten(list(authors ORDER BY n) FILTER (type in {ART})), []) AS names FROM rich_ld_rows GROUP BY page_id""",
)
cte(
    "meta_parts",
    f"""SELECT p.page_id, p.url, coalesce(f.meta_url, c.canonical) AS page_url, coalesce(f.meta_title, l.ld_title, {D_TITLE}) AS title,
  coalesce({d_normalize_authors('coalesce(l.names, [])', "case when f.meta_author is null then []::varchar[] else string_split(f.meta_author, '; ') end")}, a.author) AS author,
  coalesce(l.publisher, f.meta_site, case when contains(t.title_first, '.') then t.title_first when contains(t.title_second, '.') then t.title_second end) AS site, f.meta_description AS description,
  coalesce(cast(try_cast(regexp_extract({d_pick(PUB_META)}, '{M.ISO_DATE}', 1) as date) as varchar), case when regexp_matches(p.url, '{M.URL_DATE}') then
    cast(try_cast(regexp_extract(p.url, '{M.URL_DATE}', 1) || '-' || lpad(regexp_extract(p.url, '{M.URL_DATE}', 2), 2, '0') || '-' || lpad(regexp_extract(p.url, '{M.URL_DATE}', 3), 2, '0') as date) as varchar) end) AS date,
  case when l.ld_section is not null then replace(l.ld_section, ';', '|') else k.categories end AS categories, coalesce(nullif(f.meta_tags, ''), k.tags) AS tags, i.license,
  case when length({D_IMAGE}) <= 1000 then {D_IMAGE} end AS image, lower(nullif(regexp_extract(p.html, '{M.HTML_LANG}', 1), '')) AS lang
FROM rich_pages p JOIN meta_found f ON f.page_id = p.page_id JOIN canonicals c ON c.page_id = p.page_id JOIN rich_titles t ON t.page_id = p.page_id
LEFT JOIN rich_ld l ON l.page_id = p.page_id LEFT JOIN headings h ON h.page_id = p.page_id LEFT JOIN found_authors a ON a.page_id = p.page_id
LEFT JOIN found_licenses i ON i.page_id = p.page_id LEFT JOIN found_topics k ON k.page_id = p.page_id""",
)
D_BARE = "regexp_replace(site, '^@', '')"


@query(
    "page_meta",
    "E21",
    f"""SELECT page_id, url, page_url, title, author, description, date, categories, tags, license, image, lang,
  case when site is null then nullif(regexp_extract(page_url, '^https?://(?:www[.]|w[0-9]+[.])?([^/]+)', 1), '') when not contains({D_BARE}, '.') and regexp_matches({D_BARE}, '^[^A-ZÄÖÜ]')
  then array_to_string(list_transform(string_split({D_BARE}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') else {D_BARE} end AS sitename FROM meta_parts""",
)
def q_page_meta(spark, sf_dir):
    df = pm.page_meta(rich(spark, sf_dir))
    return df.withColumns({c: F.array_join(c, "|") for c in ("categories", "tags")})


@query("require_metadata", "E22", "SELECT page_id, url FROM pages WHERE page_id % 3 <> 0 and page_id % 4 <> 1")
def q_require_metadata(spark, sf_dir):
    df = load(spark, sf_dir, "pages").selectExpr(
        "page_id", "url", "case when page_id % 3 <> 0 then 't' end AS title", "case when page_id % 4 <> 1 then '2024-01-01' end AS date"
    )
    return M.require_metadata(df).select("page_id", "url")


@query(
    "page_language",
    "E23",
    f"SELECT page_id, lang FROM (SELECT page_id, lower(nullif(regexp_extract(html, '{M.HTML_LANG}', 1), '')) AS lang FROM pages) WHERE lang is null or lang = 'de'",
)
def q_page_language(spark, sf_dir):
    return M.page_lang(load(spark, sf_dir, "pages"), "de").select("page_id", "lang")


@query(
    "drop_authors",
    "E24",
    "SELECT doc_id, nullif(array_to_string(list_filter([source, lang, 'Ann'], lambda a: a not in ('Ann', 'en')), '; '), '') AS author FROM documents",
)
def q_drop_authors(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.concat_ws("; ", "source", "lang", F.lit("Ann")).alias("author"))
    return M.drop_authors(docs, ["Ann", "en"])


@query("drop_urls", "E25", "SELECT page_id, url FROM pages WHERE url not in (SELECT url FROM pages WHERE page_id % 9 = 0)")
def q_drop_urls(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return M.drop_urls(pages, pages.where("page_id % 9 = 0")).select("page_id", "url")


def d_duration_of_videos(page_id: str) -> str:
    """Seconds that the derived video page of a page id names."""
    return f"(case when {page_id} % 4 = 0 then 3600 else 0 end + {page_id} % 60 * 60 + {page_id} % 59)"
