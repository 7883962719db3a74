"""Text rendering of block rows, links, images and table cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import rx, sql_sanitize, sql_trim_ws, sql_unescape
from pageloom.functions.urls import IMAGE_FILE
from pageloom.operators.inrow import let
from pageloom.operators.markup import ANY_TAG, LINE_BREAK, sql_attr, sql_strip_noise

TARGET = r"\]\((.+?)\)"
IMG_TAG = r"(?i)<img(?:\s[^>]*)?>"
LEAD_IMG = r"(?i)^<img(?:\s[^>]*)?>"
LINK_OPEN = r"(?i)<(a(?:\s[^>]*)?>)"
LINK_PART = r"(?is)^(<a(?:\s[^>]*)?>)(.*?)(?:</a\s*>|\z)(.*)\z"
# Inline tags and the mark put around their text.
EMPHASIS = (
    ("b|strong", "**"),
    ("em|i", "*"),
    ("u", "__"),
    ("kbd|samp|tt|var|code", "`"),
    ("del|s|strike", "~~"),
)


def emphasis_pattern(tags: str) -> str:
    return rf"(?is)<(?:{tags})(?:\s[^>]*)?>(.*?)(?:</(?:{tags})\s*>|\z)"


def sql_image_source(tag: str) -> str:
    """Image file of a tag, the lazy-load attribute first; ``//`` becomes ``http://``."""
    lazy, src = sql_attr(tag, "data-src"), sql_attr(tag, "src")
    found = f"case when {lazy} rlike {rx(IMAGE_FILE)} then {lazy} when {src} rlike {rx(IMAGE_FILE)} then {src} end"
    return f"regexp_replace({found}, '^//', 'http://')"


def _per_part(markup: str, cut: str, show: str) -> str:
    """Cut markup before each matching tag and rewrite the parts (lambda variable ``x``)."""
    parts = f"split(regexp_replace({markup}, {rx(cut)}, concat(chr(30), '<$1')), chr(30))"
    return f"array_join(transform({parts}, x -> {show}), '')"


def _image_text() -> str:
    tag = f"regexp_extract(x, {rx(LEAD_IMG)}, 0)"
    label = f"trim(concat({sql_attr(tag, 'title')}, ' ', {sql_attr(tag, 'alt')}))"
    rest = f"regexp_replace(x, {rx(LEAD_IMG)}, '')"
    return f"case when {tag} = '' then x else concat('![', {label}, '](', coalesce({sql_image_source(tag)}, ''), ')', {rest}) end"


def _link_text() -> str:
    tag, words, rest = (f"regexp_extract(x, {rx(LINK_PART)}, {g})" for g in (1, 2, 3))
    target = sql_attr(tag, "href")
    bare = sql_trim_ws(f"regexp_replace({words}, {rx(ANY_TAG)}, '')")
    goal = f"case when {target} = '' then '' else concat('(', {target}, ')') end"
    return (
        f"case when {tag} = '' then x when {bare} = '' then concat({words}, {rest}) "
        f"else concat('[', {words}, ']', {goal}, {rest}) end"
    )


def sql_render_inline(markup: str, formatting: bool = True, links: bool = True, images: bool = False) -> str:
    """Inline markup as text with link, emphasis and image marks."""
    plain = markup
    if images:
        markup = _per_part(markup, r"(?i)<(img(?:\s[^>]*)?>)", _image_text())
    if links:
        markup = _per_part(markup, LINK_OPEN, _link_text())
    if formatting:
        for tags, mark in EMPHASIS:
            markup = f"regexp_replace({markup}, {rx(emphasis_pattern(tags))}, '{mark}$1{mark}')"
    markup = f"regexp_replace(regexp_replace({markup}, {rx(LINE_BREAK)}, chr(10)), {rx(ANY_TAG)}, '')"
    return sql_unescape(sql_sanitize(f"(case when instr({plain}, '<') > 0 then {markup} else {plain} end)"))


def _sql_line(role: str, tag: str, shown: str, formatting: bool) -> str:
    bars = f"repeat('=', case when {tag} rlike '^h[1-6]$' then cast(substring({tag}, 2, 1) as int) else 2 end)"
    head = f"when {role} = 'head' then concat({bars}, ' ', {shown}, ' ', {bars})" if formatting else ""
    return f"""case when {shown} = '' then '' when {role} = 'item' then concat('- ', {shown})
          when {role} = 'cell' then concat('|', {shown}, '|') {head} else {shown} end"""


def sql_line(row: str, formatting: bool = True, links: bool = True, images: bool = False) -> str:
    """The block row in the struct ``row`` as text."""
    shown = sql_render_inline("w.flow", formatting, links, images)
    return let("w", row, let("shown", shown, _sql_line("w.role", "w.tag", "shown", formatting)))


def render_lines(df: DataFrame, formatting: bool = True, links: bool = True, images: bool = False) -> DataFrame:
    """Add ``line``: the block row as text."""
    shown = df.selectExpr("*", f"{sql_render_inline('flow', formatting, links, images)} AS _shown")
    return shown.selectExpr("*", f"{_sql_line('role', 'tag', '_shown', formatting)} AS line").drop("_shown")


def sql_ordered_text(value: str, sep: str = "chr(10)", order: str = "pos") -> str:
    """Aggregate: values of a group joined in row order."""
    rows = f"array_sort(collect_list(named_struct('o', {order}, 'v', {value})))"
    return f"array_join(transform({rows}, r -> r.v), {sep})"


def render(df: DataFrame, formatting: bool = True, links: bool = True, images: bool = False) -> DataFrame:
    """(page_id, text): block rows of each page as one text, empty lines dropped."""
    lines = render_lines(df, formatting, links, images).where("line <> ''")
    return lines.groupBy("page_id").agg(F.expr(sql_ordered_text("line")).alias("text"))


def neighbors(df: DataFrame, key: str = "page_id", text: str = "text") -> DataFrame:
    """(key, n, target): link targets of a rendered text, in order."""
    return df.selectExpr(key, f"posexplode(regexp_extract_all({text}, {rx(TARGET)}, 1)) AS (n, target)")


def images(pages: DataFrame) -> DataFrame:
    """(page_id, n, src, alt, title) of the images that name an image file."""
    found = f"posexplode(regexp_extract_all({sql_strip_noise('html')}, {rx(IMG_TAG)}, 0)) AS (n, img)"
    return (
        pages.selectExpr("page_id", found)
        .selectExpr(
            "page_id",
            "n",
            f"{sql_image_source('img')} AS src",
            f"{sql_attr('img', 'alt')} AS alt",
            f"{sql_attr('img', 'title')} AS title",
        )
        .where("src is not null")
    )


def table_cells(df: DataFrame) -> DataFrame:
    """(page_id, table_no, row_no, col_no, role, text); a table ends at the first table inside it."""
    w = "OVER (PARTITION BY page_id, table_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    rows = df.where("table_no > 0").selectExpr(
        "page_id", "pos", "tag", "text", "table_no",
        f"max(in_table > 1) {w} AS _nested",
        f"count_if(tag = 'tr' and not closing) {w} AS row_no",
        f"count_if(tag in ('td', 'th') and not closing) {w} AS _cell",
        f"last_value(case when tag in ('td', 'th') then not closing when tag in ('tr', 'table') then false end) IGNORE NULLS {w} AS _open",
    )
    cells = (
        rows.where("not _nested and _open")
        .groupBy("page_id", "table_no", "row_no", "_cell")
        .agg(
            F.expr("max(case when tag = 'th' then 'head' else 'cell' end)").alias("role"),
            F.expr(sql_trim_ws(sql_ordered_text("text", "' '"))).alias("text"),
        )
    )
    col_no = "_cell - min(_cell) OVER (PARTITION BY page_id, table_no, row_no) + 1 AS col_no"
    return cells.selectExpr("page_id", "table_no", "row_no", col_no, "role", "text")
