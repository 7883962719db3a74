"""Page metadata: head tags, title, authors, dates, categories, licence.

The head of a page is one short value, so its tags are kept as an array of structs on the
page row and every field is picked from that array. Nothing is exploded or shuffled until
`page_meta` joins the JSON-LD and page-structure fields by page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import rx, sql_first_of, sql_list, sql_trim_ws, sql_unescape
from pageloom.functions.urls import VALID_URL
from pageloom.operators.inrow import bind
from pageloom.operators.markup import ANY_TAG, sql_attr, sql_strip_noise

HEAD = r"(?is)<head(?:\s[^>]*)?>(.*?)(?:</head\s*>|<body|\z)"
HEAD_TAG = r"(?is)<(?:meta|link)\s[^>]*>"
TITLE_TAG = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
# The parts before and after the last hyphen or bar that stands between blanks.
TITLE_SPLIT = r"(?s)^(.*\S)?\s+[|-]\s+(\S.*)$"
HTML_LANG = r"(?is)<html[^>]*\slang\s*=\s*.?([A-Za-z]{2})"

# Meta names per field.
META_FIELDS = {
    "author": (
        "article:author author byl citation_author dc.creator dc.creator.aut dc:creator dcterms.creator dcterms.creator.aut "
        "parsely-author sailthru.author shareaholic:article_author_name"
    ).split(),
    "description": (
        "dc.description dc:description dcterms.abstract dcterms.description description sailthru.description twitter:description"
    ).split(),
    "publisher": (
        "article:publisher citation_journal_title copyright dc.publisher dc:publisher dcterms.publisher publisher"
    ).split(),
    "tag": "citation_keywords dcterms.subject keywords parsely-tags shareaholic:keywords tags".split(),
    "title": (
        "citation_title dc.title dcterms.title fb_title parsely-title sailthru.title shareaholic:title title twitter:title"
    ).split(),
    "site": "twitter:site application-name".split(),
}
# Licence codes.
LICENSE_CODES = "by-nc-nd by-nc-sa by-nc by-nd by-sa by zero".split()
LICENSE_PATH = "/(" + "|".join(LICENSE_CODES) + r")/([0-9]+\.[0-9]+)"
LICENSE_TEXT = r"(?i)\b((?:cc|creative commons) (?:" + "|".join(LICENSE_CODES) + r")\b(?: [0-9]+\.[0-9]+)?)"
URL_DATE = r"/((?:19|20)[0-9]{2})[/-](0?[1-9]|1[0-2])[/-](0?[1-9]|[12][0-9]|3[01])(?:/|$|[^0-9])"
ISO_DATE = r"^\s*((?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})"
DURATION = r"^P(?:T)?(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?$"

# How author lines are taken apart: marks and words between names, and what is cut from each name, in this order.
AUTHOR_SPLIT = r"(?i)[/;,|&]|(?:^|\s)(?:and|und)(?:\s|$)"
AUTHOR_SKIP = r"(?i)^\s*https?:|^\S+@\S+\.\S+"
PREPOSITIONS = "am at bei for from in of on to via with".split()
BY_WORDS = ("written by", "words by", "story by", "photo by", "by", "von", "par", "por")
AUTHOR_CUTS = {
    "handle": r"@\w+",
    "pictographs": r"[\p{So}\p{Sk}\x{200d}\x{fe0f}]+",
    "nickname": r"\([^)]*\)|\[[^\]]*\]|\{[^}]*\}|\x22[^\x22]*\x22|“[^”]*”|‘[^’]*’|\x27[^\x27]*\x27(?:\s|$)",
    "marks": r"[:?!*$#%<>~(){}]+",
    "by": r"(?i)^\s*(?:" + "|".join(BY_WORDS) + r")\s+",
    "from a digit on": r"(?s)[0-9].*$",
    "from a preposition on": r"(?is)\s(?:" + "|".join(PREPOSITIONS) + r")\s.*$",
    "marks at the end": r"[^\p{L}\p{N}]+$",
    "blanks at the start": r"^[\s\p{Z}]+",
}
AUTHOR_STEPS = (("[._+]", " "), *((pattern, "") for pattern in AUTHOR_CUTS.values()))
QUOTES = r"[\x22\x27]"


def with_head(pages: DataFrame, plain: str = sql_strip_noise("html")) -> DataFrame:
    """Add ``metas``: array of (tag, prop, name, itemprop, rel, type, hreflang, href, content).

    ``plain`` is the page without noise, which a caller with more use for it keeps in a column.
    """
    head = f"regexp_extract({plain}, {rx(HEAD)}, 1)"
    # `property` is matched exactly, `name` without case.
    fields = {
        "tag": f"lower(regexp_extract(x, {rx(r'^<([A-Za-z]+)')}, 1))",
        "prop": sql_attr("x", "property"),
        "name": f"lower({sql_attr('x', 'name')})",
        "itemprop": sql_attr("x", "itemprop"),
        "rel": sql_attr("x", "rel"),
        "type": sql_attr("x", "type"),
        "hreflang": sql_attr("x", "hreflang"),
        "href": sql_unescape(sql_attr("x", "href")),
        "content": f"regexp_replace({sql_unescape(sql_attr('x', 'content'))}, {rx(ANY_TAG)}, '')",
    }
    struct = ", ".join(f"'{n}', {e}" for n, e in fields.items())
    tags = f"transform(regexp_extract_all({head}, {rx(HEAD_TAG)}, 0), x -> named_struct({struct}))"
    title = sql_trim_ws(sql_unescape(f"regexp_extract({head}, {rx(TITLE_TAG)}, 1)"))
    return pages.selectExpr("*", f"{tags} AS metas", f"nullif({title}, '') AS title_tag")


def meta_rows(pages: DataFrame) -> DataFrame:
    """One row per head tag."""
    return with_head(pages).selectExpr("page_id", "posexplode(metas) AS (n, m)").select("page_id", "n", "m.*")


def sql_pick(cond: str, last: bool = False, field: str = "content") -> str:
    """First (or last) non-empty ``field`` of the head tags that meet ``cond`` on ``m``."""
    found = f"filter(metas, m -> m.{field} <> '' and ({cond}))"
    return f"try_element_at({found}, {-1 if last else 1}).{field}"


def opengraph_fields() -> dict[str, str]:
    fields = {
        "og_title": "m.prop = 'og:title' or m.name = 'og:title'",
        "og_author": "m.prop in ('og:author', 'og:article:author')",
        "og_url": f"m.prop = 'og:url' and m.content rlike {rx(VALID_URL)}",
        "og_description": "m.prop = 'og:description'",
        "og_site": "m.prop = 'og:site_name'",
    }
    return {n: sql_pick(c, last=True) for n, c in fields.items()}


def opengraph(df: DataFrame) -> DataFrame:
    """Open Graph fields; ``og_complete`` says that all five are there."""
    og = opengraph_fields()
    return df.selectExpr("*", *[f"{e} AS {n}" for n, e in og.items()]).selectExpr(
        "*", f"{' and '.join(f'{n} is not null' for n in og)} AS og_complete"
    )


def _named(field: str) -> str:
    return f"(m.prop = '' and m.name in {sql_list(META_FIELDS[field])})"


def sql_normalize_authors(candidates: str, start: str = "cast(array() as array<string>)") -> str:
    """Names out of an array of author strings, joined by ``; ``; null if none is left."""
    split = f"flatten(transform(filter({candidates}, a -> not a rlike {rx(AUTHOR_SKIP)}), a -> split({sql_unescape('a')}, {rx(AUTHOR_SPLIT)})))"
    clean = "trim(a)"
    for pattern, new in AUTHOR_STEPS:
        clean = f"regexp_replace({clean}, {rx(pattern)}, '{new}')"
    names = f"filter(transform({split}, a -> {clean}), a -> a <> '' and (instr(a, ' ') > 0 or instr(a, '-') > 0 or length(a) < 50))"
    cased = f"transform({names}, a -> case when a rlike '^[^A-ZÄÖÜÉÈÁÍÓÚÑÇ]' then array_join(transform(split(a, '-'), p -> initcap(p)), '-') else a end)"
    # a name that holds an earlier one is left out
    new = "filter(all, (a, i) -> not exists(slice(all, 1, i), b -> instr(a, b) > 0))"
    return f"nullif(array_join(transform(array(concat({start}, {cased})), all -> {new})[0], '; '), '')"


def normalize_authors(df: DataFrame, column: str, name: str = "authors") -> DataFrame:
    return df.selectExpr("*", f"{sql_normalize_authors(f'array({column})')} AS {name}")


def sql_tags(c: str) -> str:
    plain = f"regexp_replace({sql_trim_ws(sql_unescape(c))}, {rx(QUOTES)}, '')"
    return f"array_join(filter(split({plain}, ', '), t -> t <> ''), ', ')"


def meta_fields(df: DataFrame) -> DataFrame:
    """meta_title, meta_author, meta_url, meta_description, meta_site, meta_tags.

    The first value wins; authors and tags accumulate. With a complete set of Open Graph
    fields nothing else is read.
    """
    df = opengraph(df)
    author_tag = f"m.prop in ('author', 'article:author') or {_named('author')} or (m.prop = '' and m.name = '' and m.itemprop = 'author')"
    described = f"{_named('description')} or (m.prop = '' and m.name = '' and m.itemprop = 'description')"
    titled = f"{_named('title')} or (m.prop = '' and m.name = '' and m.itemprop = 'headline')"
    published = f"m.prop = 'article:publisher' or {_named('publisher')}"
    backup = f"m.prop = '' and (m.name in {sql_list(META_FIELDS['site'])} or instr(m.name, 'twitter:app:name') > 0)"
    twitter_url = f"m.prop = '' and m.name = 'twitter:url' and m.content rlike {rx(VALID_URL)}"
    names = f"transform(filter(metas, m -> m.content <> '' and ({author_tag})), m -> m.content)"
    start = "case when og_author is null then cast(array() as array<string>) else array(og_author) end"
    tags = (
        f"filter(transform(filter(metas, m -> m.content <> '' and (m.prop = 'article:tag' or {_named('tag')})), "
        f"m -> {sql_tags('m.content')}), t -> t <> '')"
    )

    def unless_complete(og: str, other: str) -> str:
        return f"case when og_complete then {og} else coalesce({og}, {other}) end"

    return df.selectExpr(
        "*",
        f"{unless_complete('og_title', sql_pick(titled))} AS meta_title",
        f"case when og_complete then og_author else {sql_normalize_authors(names, start)} end AS meta_author",
        f"{unless_complete('og_url', sql_pick(twitter_url))} AS meta_url",
        f"{unless_complete('og_description', sql_pick(described))} AS meta_description",
        f"case when og_complete then og_site else coalesce(og_site, {sql_pick(published)}, {sql_pick(backup, last=True)}) end AS meta_site",
        f"case when og_complete then cast(array() as array<string>) else {tags} end AS meta_tags",
    )


def title_parts(df: DataFrame, title: str = "title_tag") -> DataFrame:
    """Add title_first, title_second around the last separator, and title_site (dotted part)."""
    return df.selectExpr(
        "*",
        f"nullif(regexp_extract({title}, {rx(TITLE_SPLIT)}, 1), '') AS title_first",
        f"nullif(regexp_extract({title}, {rx(TITLE_SPLIT)}, 2), '') AS title_second",
    ).selectExpr(
        "*",
        "case when instr(title_first, '.') > 0 then title_first when instr(title_second, '.') > 0 then title_second end AS title_site",
    )


def heading_fields(blocks: DataFrame) -> DataFrame:
    """Per page: h1 texts, title-classed heading, first h2, first paragraph; one aggregate."""
    heads = "not closing and tag in ('h1', 'h2', 'h3')"
    first = "min(case when {c} then named_struct('o', pos, 'v', text) end).v"
    return blocks.groupBy("page_id").agg(
        F.expr("count_if(tag = 'h1' and not closing)").alias("n_h1"),
        F.expr(first.format(c="tag = 'h1' and not closing")).alias("first_h1"),
        F.expr(first.format(c="tag = 'h2' and not closing")).alias("first_h2"),
        F.expr(first.format(c=f"{heads} and instr(cls, 'title') > 0 and text_len between 3 and 199")).alias("classed"),
        F.expr(first.format(c="tag = 'p' and not closing and text_len > 0 and in_article > 0")).alias("article_p"),
        F.expr(first.format(c="tag = 'p' and not closing and text_len > 0")).alias("first_p"),
        F.expr(first.format(c="tag = 'h1' and not closing and in_article > 0 and text_len > 0")).alias("article_h1"),
    )


def structure_steps(on) -> list[tuple[str, str]]:
    """Heading fields, found_author, license, found_cats and found_tags from ``rows``, the rows of one page in order.

    ``on`` binds the columns of a rule to the row ``r``. The same rules as in ``heading_fields``, ``page_author``,
    ``page_license`` and ``cats_tags``, which take exploded rows. The rows carry ``CARRIED``, and those that do not fit
    ``STRUCTURE_ROWS`` may be left out.
    """

    def first(rule: str) -> str:
        return f"try_element_at(filter(rows, r -> {on(rule)}), 1).text"

    heads = "not closing and tag in ('h1', 'h2', 'h3')"
    lead = f"regexp_extract(h, {rx('^<[^>]*>')}, 0)"
    label = sql_trim_ws(sql_unescape(f"regexp_replace(h, {rx(ANY_TAG)}, '')"))
    carried = {n: on(e) for n, e in (("pos", "pos"), ("quiet", "in_byline_noise = 0"), ("foot", "in_footer > 0 or in_footer_named > 0"), ("topic", "in_topics > 0"))}
    one = ", ".join([*[f"'{n}', {e}" for n, e in carried.items()], "'n', k", f"'href', {sql_unescape(sql_attr(lead, 'href'))}", f"'rel', {sql_attr(lead, 'rel')}", f"'label', {label}"])
    anchors_of = f"transform(regexp_extract_all(r.flow, {rx(ANCHOR)}, 0), (h, k) -> named_struct({one}))"
    links = f"filter(flatten(transform(filter(rows, r -> instr(r.flow, '<') > 0), r -> {anchors_of})), l -> l.href <> '')"

    by_link = "transform(filter(links, l -> l.quiet and l.rel = 'author'), l -> named_struct('r', 1, 'o', l.pos, 'n', l.n, 'v', l.label))"
    by_name = f"transform(filter(rows, r -> {on('in_byline_noise = 0 and not closing')}), r -> named_struct('r', r.rank, 'o', r.pos, 'n', 0, 'v', r.text))"
    named = f"array_min(filter(concat({by_link}, {by_name}), c -> c.r is not null and length(c.v) between 3 and 119)).v"
    cc = bind(sql_license_code(), "l", ["href"])
    strong = f"transform(filter(links, l -> l.rel = 'license'), l -> coalesce({cc}, nullif(l.label, '')))"
    weak = f"transform(filter(links, l -> l.foot), l -> coalesce({cc}, nullif(regexp_extract(l.label, {rx(LICENSE_TEXT)}, 1), '')))"

    def found(values: str) -> str:
        return f"try_element_at(filter({values}, t -> t is not null), 1)"

    def listed(pattern: str) -> str:
        shown = "filter(links, l -> l.topic and l.label <> '')"
        some = f"array_distinct(transform(filter({shown}, l -> l.href rlike {rx(pattern)}), l -> l.label))"
        return f"if(size({shown}) > 0, {some}, null)"

    h1 = "tag = 'h1' and not closing"
    return [
        ("n_h1", f"size(filter(rows, r -> {on(h1)}))"),
        ("first_h1", first(h1)),
        ("first_h2", first("tag = 'h2' and not closing")),
        ("classed", first(f"{heads} and titled and text_len between 3 and 199")),
        ("links", links),
        ("named", named),
        ("found_author", f"if(named is null, null, {sql_normalize_authors('array(named)')})"),
        ("license", f"coalesce({found(strong)}, {found(weak)})"),
        ("found_cats", listed(CATEGORY_PATH)),
        ("found_tags", listed(TAG_PATH)),
    ]


SQL_TITLE = """case when n_h1 = 1 and first_h1 <> '' then first_h1 when classed is not null then classed
  when title_first is not null and instr(title_first, '.') = 0 then title_first
  when title_second is not null and instr(title_second, '.') = 0 then title_second
  when n_h1 > 0 then first_h1 when first_h2 is not null then first_h2 else title_tag end"""


def sql_simple_title() -> str:
    return sql_first_of(
        sql_pick("m.prop = 'og:title' or m.name = 'og:title'"),
        sql_pick("m.name = 'twitter:title'"),
        sql_pick("m.tag = 'meta' and m.itemprop = 'name'"),
        "article_h1",
        "title_tag",
    )


def sql_simple_description() -> str:
    return sql_first_of(
        sql_pick("m.prop = 'og:description' or m.name = 'og:description'"),
        sql_pick("m.name = 'twitter:description'"),
        sql_pick("m.itemprop = 'description'"),
        sql_pick("m.name = 'description'"),
        "article_p",
        "first_p",
    )


def lead_image(df: DataFrame, plain: str = sql_strip_noise("html")) -> DataFrame:
    """Add ``image``: Open Graph, Twitter, itemprop, icon, any image; over 1000 characters is null."""
    first_img = f"regexp_extract({plain}, {rx(IMG_WITH_SRC)}, 0)"
    img = f"nullif({sql_attr(first_img, 'src')}, '')"
    found = sql_first_of(
        sql_pick("m.prop = 'og:image'"),
        sql_pick("m.name = 'twitter:image'"),
        sql_pick("m.itemprop = 'image'"),
        sql_pick("m.tag = 'link' and m.rel = 'icon'", field="href"),
        img,
    )
    return df.selectExpr("*", f"{found} AS _image").selectExpr(
        *df.columns, "case when length(_image) <= 1000 then _image end AS image"
    )


IMG_WITH_SRC = r"(?is)<img\s[^>]*>"


def canonical_url(df: DataFrame, default: str = "url") -> DataFrame:
    """Add ``canonical``: canonical link, x-default alternate, given URL; domain added, validated."""
    usable = r"m.href rlike r'^(https?://|/)'"
    found = f"""coalesce({sql_pick(f"m.rel = 'canonical' and {usable}", field="href")},
      {sql_pick(f"m.rel = 'alternate' and m.hreflang = 'x-default' and {usable}", last=True, field="href")}, {default})"""
    site = f"""nullif(regexp_extract({sql_pick("(m.name like 'og:%' or m.name like 'twitter:%' or m.prop like 'og:%' or m.prop like 'twitter:%') and m.content rlike '^https?://[^/]+'")}, '^https?://[^/]+', 0), '')"""
    return (
        df.selectExpr("*", f"{found} AS _found", f"{site} AS _site")
        .selectExpr("*", "case when startswith(_found, '/') then coalesce(concat(_site, _found), _found) else _found end AS _full")
        .selectExpr(*df.columns, f"case when _full rlike {rx(VALID_URL)} then _full end AS canonical")
    )


def site_name(df: DataFrame, name: str = "site", url: str = "url") -> DataFrame:
    """Add ``sitename``: ``@`` dropped, title case if lower and undotted, else the URL's host."""
    bare = f"regexp_replace({name}, '^@', '')"
    host = f"nullif(regexp_extract({url}, {rx(r'^https?://(?:www[.]|w[0-9]+[.])?([^/]+)')}, 1), '')"
    return df.selectExpr(
        "*",
        f"""case when {name} is null then {host} when instr({bare}, '.') = 0 and {bare} rlike '^[^A-ZÄÖÜ]' then initcap({bare})
          else {bare} end AS sitename""",
    )


CATEGORY_PATH, TAG_PATH = r"/categor(?:y|ies|ys)/", r"/tags?/"
AUTHOR_RANK = r"""case when cls rlike '(^|[\\s_-])author([\\s_-]|$)' then 2 when cls rlike 'byline' then 3
      when cls rlike 'writer|contributor' then 4 when open_tag rlike '(?i)itemprop\\s*=\\s*.?author' then 5 when tag = 'address' then 6 end"""
ANCHOR = r"(?is)<a\s[^>]*>.*?(?:</a\s*>|\z)"
#: What a row of ``structure_steps`` carries, as SQL over ``tag``, ``closing``, ``open_tag`` and ``cls``, and its type.
CARRIED = {
    "rank": (f"if(instr(open_tag, '=') > 0, {AUTHOR_RANK}, if(tag = 'address', 6, null))", "int"),
    "titled": ("instr(cls, 'title') > 0", "boolean"),
}
_REL = rx(r"(?i)\srel\s*=")
#: The rows that ``structure_steps`` reads: headings, named authors, and links that say what they are by ``rel`` or place.
STRUCTURE_ROWS = f"""(not closing and (tag in ('h1', 'h2', 'h3') or (rank is not null and in_byline_noise = 0)))
  or ((link_tag is not null or instr(inner_html, '<') > 0)
    and (in_footer > 0 or in_footer_named > 0 or in_topics > 0 or link_tag rlike {_REL} or inner_html rlike {_REL}))"""


def anchors(blocks: DataFrame) -> DataFrame:
    """Links with an href of block rows: (…, n, href, rel, label, anchor)."""
    rows = blocks.where("instr(flow, '<') > 0").selectExpr(
        *[c for c in blocks.columns if c != "flow"], f"posexplode(regexp_extract_all(flow, {rx(ANCHOR)}, 0)) AS (n, anchor)"
    )
    lead = f"regexp_extract(anchor, {rx('^<[^>]*>')}, 0)"
    label = sql_trim_ws(sql_unescape(f"regexp_replace(anchor, {rx(ANY_TAG)}, '')"))
    return rows.selectExpr(
        "*", f"{sql_unescape(sql_attr(lead, 'href'))} AS href", f"{sql_attr(lead, 'rel')} AS rel", f"{label} AS label"
    ).where("href <> ''")


def cats_tags(blocks: DataFrame) -> DataFrame:
    """Per page: unique categories and tags in order, from links in meta areas."""
    found = anchors(blocks.where("in_topics > 0")).where("label <> ''")

    def listed(pattern: str) -> str:
        row = f"case when href rlike {rx(pattern)} then named_struct('o', pos, 'n', n, 'v', label) end"
        return f"array_distinct(transform(array_sort(collect_list({row})), r -> r.v))"

    return found.groupBy("page_id").agg(
        F.expr(listed(CATEGORY_PATH)).alias("categories"), F.expr(listed(TAG_PATH)).alias("tags")
    )


def sql_license_code() -> str:
    """Creative Commons licence that ``href`` points at."""
    return f"""case when href rlike {rx(LICENSE_PATH)} then concat('CC ', upper(regexp_extract(href, {rx(LICENSE_PATH)}, 1)), ' ',
      regexp_extract(href, {rx(LICENSE_PATH)}, 2)) end"""


def page_license(blocks: DataFrame) -> DataFrame:
    """Per page: licence of a rel=license link, else Creative Commons hints in a footer."""
    cc = sql_license_code()
    marked = anchors(blocks).selectExpr(
        "page_id", "pos", "n",
        f"case when rel = 'license' then coalesce({cc}, nullif(label, '')) end AS strong",
        f"""case when in_footer > 0 or in_footer_named > 0 then coalesce({cc}, nullif(regexp_extract(label, {rx(LICENSE_TEXT)}, 1), '')) end AS weak""",
    )
    first = "min(case when {c} is not null then named_struct('o', pos, 'n', n, 'v', {c}) end).v"
    both = f"coalesce({first.format(c='strong')}, {first.format(c='weak')})"
    return marked.groupBy("page_id").agg(F.expr(both).alias("license")).where("license is not null")


def page_author(blocks: DataFrame) -> DataFrame:
    """Per page: text of the first author rule that fits, 3-119 characters, noise sections out.

    Rules in order: author link; then rows named author, byline, writer, contributor, and
    address elements.
    """
    quiet = blocks.where("in_byline_noise = 0")
    links = anchors(quiet).where("rel = 'author'").selectExpr("page_id", "1 AS rank", "pos", "n", "label AS name")
    rows = quiet.where("not closing").selectExpr("page_id", f"{AUTHOR_RANK} AS rank", "pos", "0 AS n", "text AS name").where("rank is not null")
    both = links.unionByName(rows).where("length(name) between 3 and 119")
    best = both.groupBy("page_id").agg(F.expr("min(named_struct('r', rank, 'o', pos, 'n', n, 'v', name)).v").alias("name"))
    return best.selectExpr("page_id", f"{sql_normalize_authors('array(name)')} AS author").where("author is not null")


def page_date(df: DataFrame, json_date: str = "cast(null as string)", url: str = "url") -> DataFrame:
    """Add ``date`` (ISO): publication meta tags, JSON-LD date, date in the URL path."""
    meta = sql_pick("m.prop in ('article:published_time', 'og:published_time') or m.name in ('date', 'dc.date', 'dcterms.created', 'pubdate', 'citation_publication_date') or m.itemprop = 'datePublished'")
    in_url = (
        f"concat(regexp_extract({url}, {rx(URL_DATE)}, 1), '-', lpad(regexp_extract({url}, {rx(URL_DATE)}, 2), 2, '0'), '-', "
        f"lpad(regexp_extract({url}, {rx(URL_DATE)}, 3), 2, '0'))"
    )
    parts = [f"cast(try_to_date(nullif(regexp_extract({c}, {rx(ISO_DATE)}, 1), '')) as string)" for c in (meta, json_date)]
    parts.append(f"case when {url} rlike {rx(URL_DATE)} then cast(try_to_date({in_url}) as string) end")
    return df.selectExpr("*", f"coalesce({', '.join(parts)}) AS date")


def sql_duration(c: str) -> str:
    """Seconds of an ISO-8601 duration with hours, minutes, seconds; null if it is none."""
    part = [f"coalesce(cast(nullif(regexp_extract({c}, {rx(DURATION)}, {g}), '') as bigint), 0)" for g in (1, 2, 3)]
    return f"case when {c} rlike {rx(DURATION)} and {c} rlike '[0-9]' then {part[0]} * 3600 + {part[1]} * 60 + {part[2]} end"


AUTHOR_SPAN = r"(?is)<span[^>]*itemprop\s*=\s*.?author[^>]*>(.*?)</span\s*>"
URL_LINK = r"(?is)<link[^>]*itemprop\s*=\s*.?url[^>]*>"


def video_page(pages: DataFrame) -> DataFrame:
    """Record of a video page: title, seconds, date, image, author, tags, categories."""

    def item(name: str, field: str = "content") -> str:
        return sql_pick(f"m.itemprop = '{name}'", field=field)

    def listed(c: str) -> str:
        return f"transform(split({c}, ','), t -> trim(t))"

    span = f"regexp_extract(html, {rx(AUTHOR_SPAN)}, 1)"
    author = f"nullif({sql_attr(f'regexp_extract({span}, {rx(URL_LINK)}, 0)', 'href')}, '')"
    return with_head(pages).selectExpr(
        "page_id",
        f"{item('name')} AS title",
        f"{sql_duration(item('duration'))} AS duration",
        f"{item('datePublished')} AS date",
        f"{item('thumbnailUrl', 'href')} AS image",
        f"{author} AS author",
        listed(sql_pick("m.name = 'keywords'")) + " AS tags",
        listed(item("genre")) + " AS categories",
    )


def page_lang(df: DataFrame, lang: str | None = None) -> DataFrame:
    """Add ``lang`` declared by the page; with a target, drop pages that declare another."""
    out = df.selectExpr("*", f"lower(nullif(regexp_extract(html, {rx(HTML_LANG)}, 1), '')) AS lang")
    return out if lang is None else out.where(f"lang is null or lang = '{lang}'")


def require_metadata(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["title", "url", "date"])


def drop_authors(df: DataFrame, banned: list[str], column: str = "author") -> DataFrame:
    """Remove listed names from ``; ``-joined authors."""
    kept = F.array_except(F.split(column, "; "), F.array(*[F.lit(b) for b in banned]))
    return df.withColumn(column, F.nullif(F.array_join(kept, "; "), F.lit("")))


def drop_urls(df: DataFrame, banned: DataFrame) -> DataFrame:
    """Rows whose URL is not listed."""
    return df.join(banned.select("url").distinct(), "url", "left_anti")
