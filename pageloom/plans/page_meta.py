"""Metadata record of a page by precedence: meta tags, JSON-LD, page structure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import rx
from pageloom.operators import jsonld, markup, metadata
from pageloom.operators.inrow import staged
from pageloom.operators.pagerows import PageRows

ROWS = PageRows(("byline_noise", "footer_named", "topics"), metadata.CARRIED, links=False, tree=("pos", "tag", "closing", "inner_html", "in_footer", "link_tag", "in_head", "ins"))


def structure_fields(pages: DataFrame, *keep: str, plain: str = markup.sql_strip_noise("html")) -> DataFrame:
    """The columns ``keep`` of each page with heading fields, author, licence, categories and tags of its rows.

    All are picked from the rows inside the page's own row (``operators.pagerows``). Text is made for those rows alone
    that one of the fields can come from. ``plain`` is the page without noise.
    """
    steps = [("segs", ROWS.segments(f"coalesce({plain}, '')")), ("rows", ROWS.rows(ROWS.context("segs"), only=metadata.STRUCTURE_ROWS))]
    steps += metadata.structure_steps(ROWS.on)
    names = [n for n, _ in steps if n not in ("segs", "rows", "links", "named")]
    return staged(pages, steps, {n: n for n in names}, *keep, depth=4)


def page_meta(pages: DataFrame) -> DataFrame:
    """(page_id, url, title, author, sitename, description, date, categories, tags, license, image, lang)."""
    # the head, the image and the rows all read the page without noise
    head = markup.by_page(pages, "url").selectExpr("*", f"{markup.sql_strip_noise('html')} AS plain")
    head = metadata.meta_fields(metadata.title_parts(metadata.with_head(head, "plain")))
    head = metadata.canonical_url(metadata.lead_image(head, "plain"))
    head = head.selectExpr("*", f"regexp_extract_all(html, {rx(jsonld.LD_SCRIPT)}, 1) AS _scripts")
    head = head.selectExpr("*", f"{jsonld.sql_scripts('_scripts')} AS _js", f"{jsonld.sql_broken('_scripts')} AS _broken")
    head = head.selectExpr("*", *[f"{e} AS broken_{n}" for n, e in jsonld.sql_salvage("_broken").items()])
    ld = jsonld.jsonld_members(head, "_js")
    ld = jsonld.jsonld_fields(ld.withColumn("members", F.expr("coalesce(members, array())")), "meta_site")
    ld = metadata.page_lang(metadata.page_date(ld, "ld_date")).drop("metas", "members", "_scripts", "_js", "_broken")
    both = structure_fields(ld, *[c for c in ld.columns if c not in ("html", "plain")], plain="plain")
    start = "case when meta_author is null then cast(array() as array<string>) else split(meta_author, '; ') end"
    named = metadata.sql_normalize_authors("ld_author_names", start)
    out = both.selectExpr(
        "page_id",
        "url",
        "coalesce(meta_url, canonical) AS page_url",
        f"coalesce(meta_title, ld_title, broken_title, {metadata.SQL_TITLE}) AS title",
        f"coalesce({named}, broken_author, found_author) AS author",
        "coalesce(ld_site, broken_sitename, title_site) AS site",
        "meta_description AS description",
        "date",
        "case when coalesce(ld_section, broken_section) is not null then split(coalesce(ld_section, broken_section), ';') else found_cats end AS categories",
        "case when size(meta_tags) > 0 then meta_tags else found_tags end AS tags",
        "license",
        "image",
        "lang",
    )
    return metadata.site_name(out, "site", "page_url").drop("site")
