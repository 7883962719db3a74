"""Queries that prune block rows and render them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import markup, prune, render
from pageloom.plans import markup_sql as d
from pageloom.plans.markup_queries import KEEP, rich, rich_blocks
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load

RULE_COLS = [f"in_{n}" for n in prune.RULES]


@query("section_flags", "D6", f"SELECT page_id, pos, {', '.join(RULE_COLS)} FROM sec")
def q_section_flags(spark, sf_dir):
    df = prune.with_sections(markup.with_containers(markup.with_context(markup.segments(rich(spark, sf_dir)))))
    return df.select("page_id", "pos", *RULE_COLS)


@query(
    "drop_sections_guarded",
    "D6",
    """SELECT page_id, pos, text FROM (SELECT *, in_boilerplate > 0 AS b,
  sum(case when in_boilerplate > 0 then 0 else text_len end) OVER (PARTITION BY page_id) * 7 > sum(text_len) OVER (PARTITION BY page_id) AS enough FROM blk)
WHERE not (b and enough)""",
)
def q_drop_sections_guarded(spark, sf_dir):
    return prune.drop_sections(
        rich_blocks(spark, sf_dir, "boilerplate"), "boilerplate", guard=True
    ).select("page_id", "pos", "text")


@query(
    "drop_sections",
    "D6",
    "SELECT page_id, pos, text FROM blk WHERE in_paywall = 0 and in_teaser = 0 and in_caption = 0 and in_extras = 0 and in_comments = 0",
)
def q_drop_sections(spark, sf_dir):
    families = ("paywall", "teaser", "caption", "extras", "comments")
    df = prune.drop_sections(rich_blocks(spark, sf_dir, *families), *families)
    return df.select("page_id", "pos", "text")


def d_main_region(source: str) -> str:
    n = len(prune.REGIONS)
    best = ", ".join(
        f"case when sum(case when in_region{i} > 0 and text_len > 0 then 1 else 0 end) OVER (PARTITION BY page_id) > 1 then {i} end"
        for i in range(1, n + 1)
    )
    inside = " ".join(f"when {i} then in_region{i}" for i in range(1, n + 1))
    return f"SELECT * FROM (SELECT *, coalesce({best}) AS region FROM {source}) WHERE case region {inside} else 0 end > 0"


@query("main_region", "D7", f"SELECT page_id, pos, region, text FROM ({d_main_region('blk')})")
def q_main_region(spark, sf_dir):
    return prune.main_region(rich_blocks(spark, sf_dir, *prune.REGIONS)).select("page_id", "pos", "region", "text")


def d_link_density(source: str, roles: str = "'div', 'p', 'item'", precision: bool = False) -> str:
    short = "n_short_precise" if precision else "n_short"
    if precision:
        roles += ", 'head', 'quote'"
    limit = (
        f"case when role = 'p' then {100 if precision else 25} "
        "when lead(pos) OVER (PARTITION BY page_id, container_id ORDER BY pos) is null then 300 else 100 end"
    )
    return (
        f"SELECT * FROM (SELECT *, {limit} AS max_len FROM {source}) WHERE not (role in ({roles}) and n_links > 0 and text_len < max_len "
        f"and (n_named = 0 or link_len > 0.8 * text_len or {short} > 0.8 * n_named))"
    )


@query("link_density_filter", "D8", f"SELECT page_id, pos, role, text FROM ({d_link_density('blk')})")
def q_link_density_filter(spark, sf_dir):
    return prune.link_density_filter(rich_blocks(spark, sf_dir)).select("page_id", "pos", "role", "text")


@query(
    "link_density_filter_precise",
    "D8",
    f"SELECT page_id, pos, role, text FROM ({d_link_density('blk', precision=True)})",
)
def q_link_density_filter_precise(spark, sf_dir):
    df = prune.link_density_filter(rich_blocks(spark, sf_dir), precision=True)
    return df.select("page_id", "pos", "role", "text")


def d_repeated(source: str, limit: int = 100) -> str:
    cand = f"(role = 'div' and n_named > 0 and text_len between 1 and {limit - 1})"
    return (
        f"SELECT * FROM (SELECT *, {cand} AS cand, sum(case when {cand} then 1 else 0 end) OVER (PARTITION BY page_id, text) AS reps "
        f"FROM {source}) WHERE not (cand and reps >= 3)"
    )


@query("repeated_links_filter", "D9", f"SELECT page_id, pos, text FROM ({d_repeated('blk')})")
def q_repeated_links_filter(spark, sf_dir):
    return prune.repeated_links_filter(rich_blocks(spark, sf_dir)).select("page_id", "pos", "text")


@query(
    "link_table_filter",
    "D10",
    """SELECT page_id, pos, text FROM (SELECT *, sum(text_len) OVER w AS t, sum(n_links) OVER w AS k, sum(n_named) OVER w AS n, sum(link_len) OVER w AS l FROM blk
  WINDOW w AS (PARTITION BY page_id, table_no))
WHERE not (table_no > 0 and k > 0 and t > 250 and (n = 0 or (t < 1000 and l > 0.8 * t) or (t > 1000 and l > 0.5 * t)))""",
)
def q_link_table_filter(spark, sf_dir):
    return prune.link_table_filter(rich_blocks(spark, sf_dir)).select("page_id", "pos", "text")


TEXT_OK = f"regexp_matches(text, '{prune.HAS_WORD}') and not regexp_matches(text, '{prune.SHARE_LINE}')"


@query("text_filter", "D11", f"SELECT page_id, pos, text FROM blk WHERE {TEXT_OK}")
def q_text_filter(spark, sf_dir):
    return prune.text_filter(rich_blocks(spark, sf_dir)).select("page_id", "pos", "text")


@query(
    "table_cells",
    "D12",
    f"""SELECT page_id, table_no, row_no, cell - min(cell) OVER (PARTITION BY page_id, table_no, row_no) + 1 AS col_no, role, text FROM (
  SELECT page_id, table_no, row_no, cell, max(case when tag = 'th' then 'head' else 'cell' end) AS role,
    {d.d_trim_ws("string_agg(text, ' ' ORDER BY pos)")} AS text FROM (
    SELECT page_id, pos, tag, text, table_no, max(case when in_table > 1 then 1 else 0 end) OVER w AS nested,
      cast(sum(case when tag = 'tr' and not closing then 1 else 0 end) OVER w as bigint) AS row_no,
      cast(sum(case when tag in ('td', 'th') and not closing then 1 else 0 end) OVER w as bigint) AS cell,
      last_value(case when tag in ('td', 'th') then not closing when tag in ('tr', 'table') then false end IGNORE NULLS) OVER w AS open_cell
    FROM blk WHERE table_no > 0 WINDOW w AS (PARTITION BY page_id, table_no ORDER BY pos ROWS UNBOUNDED PRECEDING))
  WHERE nested = 0 and open_cell GROUP BY page_id, table_no, row_no, cell)""",
)
def q_table_cells(spark, sf_dir):
    return render.table_cells(rich_blocks(spark, sf_dir))


cte("kept", f"SELECT * FROM blk WHERE {KEEP}")


@query("render_text", "D13", d.d_render("kept", images=True))
def q_render_text(spark, sf_dir):
    return render.render(markup.drop_containers(rich_blocks(spark, sf_dir), images=True), images=True)


@query(
    "page_images",
    "D14",
    f"""SELECT page_id, n - 1 AS n, {d.d_image_src('tag')} AS src, {d.d_attr('tag', 'alt')} AS alt, {d.d_attr('tag', 'title')} AS title
FROM (SELECT page_id, unnest(t) AS tag, generate_subscripts(t, 1) AS n FROM (
  SELECT page_id, regexp_extract_all({d.d_strip_noise('html')}, '{render.IMG_TAG}', 0) AS t FROM rich_pages)) WHERE {d.d_image_src('tag')} is not null""",
)
def q_page_images(spark, sf_dir):
    return render.images(rich(spark, sf_dir))


cte("rendered", d.d_render("kept"))


@query(
    "text_neighbors",
    "D15",
    r"SELECT page_id, n - 1 AS n, target FROM (SELECT page_id, unnest(t) AS target, generate_subscripts(t, 1) AS n FROM "
    r"(SELECT page_id, regexp_extract_all(text, '\]\((.+?)\)', 1) AS t FROM rendered))",
)
def q_text_neighbors(spark, sf_dir):
    return render.neighbors(render.render(markup.drop_containers(rich_blocks(spark, sf_dir), images=True)))


def d_trim_tail(source: str) -> str:
    return (
        "SELECT * FROM (SELECT *, max(case when not (role = 'head' or (n_named > 0 and link_len >= text_len)) and text_len > 0 then pos end) "
        f"OVER (PARTITION BY page_id) AS last_pos FROM {source}) WHERE pos <= last_pos"
    )


@query("trim_tail", "D16", f"SELECT page_id, pos, text FROM ({d_trim_tail('kept')})")
def q_trim_tail(spark, sf_dir):
    kept = markup.drop_containers(rich_blocks(spark, sf_dir), images=True)
    return prune.trim_tail(kept).select("page_id", "pos", "text")


@query("text_documents", "A10", d.d_render(f"(SELECT * FROM plain_blk WHERE {KEEP})"))
def q_text_documents(spark, sf_dir):
    rows = prune.page_blocks(load(spark, sf_dir, "pages"))
    return render.render(markup.drop_containers(rows, images=True))
