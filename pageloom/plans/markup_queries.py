"""Queries that flatten pages to rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import markup, prune
from pageloom.operators.markup import TRACKED
from pageloom.plans import markup_sql as d
from pageloom.plans.registry import query
from pageloom.plans.tables import load

KEEP = "in_nav = 0 and in_footer = 0 and in_aside = 0 and in_form = 0"


def rich(spark, sf_dir):
    return load(spark, sf_dir, "rich_pages")


def rich_blocks(spark, sf_dir, *rules):
    return prune.page_blocks(rich(spark, sf_dir), *rules)


@query(
    "page_tokens",
    "D1",
    f"""SELECT page_id, pos, token, lower(regexp_extract(token, '{markup.LEAD}', 2)) AS tag,
  case when not starts_with(token, '<') then 'text' when regexp_extract(token, '{markup.LEAD}', 2) = '' then 'other'
    when starts_with(token, '</') then 'close' else 'open' end AS kind
FROM (SELECT page_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM (
  SELECT page_id, regexp_extract_all({d.d_strip_noise('html')}, '{markup.TOKEN}', 0) AS t FROM rich_pages))""",
)
def q_page_tokens(spark, sf_dir):
    return markup.tokens(rich(spark, sf_dir))


@query(
    "container_context",
    "D2",
    "SELECT page_id, pos, tag, depth, container_id, parent_id, table_no, cast(in_head as int) AS in_head, cast(in_link as int) AS in_link, "
    + ", ".join(f"in_{k}" for k in TRACKED)
    + " FROM tree",
)
def q_container_context(spark, sf_dir):
    df = markup.with_containers(markup.with_context(markup.segments(rich(spark, sf_dir))))
    return df.select(
        "page_id", "pos", "tag", "depth", "container_id", "parent_id", "table_no",
        F.col("in_head").cast("int").alias("in_head"), F.col("in_link").cast("int").alias("in_link"),
        *[f"in_{k}" for k in TRACKED],
    )


BLOCK_COLS = ["page_id", "pos", "role", "text", "text_len", "n_links", "n_named", "link_len", "n_short", "n_short_precise"]


@query("page_blocks", "D3", f"SELECT {', '.join(BLOCK_COLS)} FROM blk")
def q_page_blocks(spark, sf_dir):
    return rich_blocks(spark, sf_dir).select(*BLOCK_COLS)


@query("page_blocks_given", "D3", f"SELECT {', '.join(BLOCK_COLS)} FROM plain_blk")
def q_page_blocks_given(spark, sf_dir):
    return prune.page_blocks(load(spark, sf_dir, "pages")).select(*BLOCK_COLS)


@query("drop_containers", "D4", f"SELECT page_id, pos, text FROM blk WHERE {KEEP} and in_table = 0 and in_figure = 0")
def q_drop_containers(spark, sf_dir):
    df = markup.drop_containers(rich_blocks(spark, sf_dir), tables=False, images=False)
    return df.select("page_id", "pos", "text")


@query("drop_empty", "D5", "SELECT page_id, pos, role FROM blk WHERE text <> ''")
def q_drop_empty(spark, sf_dir):
    return markup.drop_empty(rich_blocks(spark, sf_dir)).select("page_id", "pos", "role")


@query(
    "misused_divs",
    "D30",
    "SELECT page_id, pos, tag, text FROM blk WHERE role = 'div' and text <> ''",
)
def q_misused_divs(spark, sf_dir):
    df = markup.drop_empty(rich_blocks(spark, sf_dir))
    return df.where(F.col("role") == "div").select("page_id", "pos", "tag", "text")


@query(
    "page_size_guard",
    "D29",
    "SELECT page_id, pos, tag FROM (SELECT *, count(*) OVER (PARTITION BY page_id) AS n FROM seg) WHERE n <= 180",
)
def q_page_size_guard(spark, sf_dir):
    return markup.size_guard(markup.segments(rich(spark, sf_dir)), 180).select("page_id", "pos", "tag")
