"""Pages flattened to rows: tokens, block segments with container context, blocks.

A page is cut into rows by one `split` on block-level tags, so every row already holds
its lead tag and the inline markup up to the next block tag. Pages are hashed on
`page_id` once, as raw HTML rows and before the explode: every window and aggregate
below is keyed on the page first and reuses that exchange. One page is one input value,
so a page group is bounded by the size of one stored response.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import rx, sql_list, sql_trim_ws, sql_unescape

# Block tags whose end tag authors always write; depth is counted on these.
CONTAINERS = (
    "address article aside blockquote body details div dl fieldset figure footer form "
    "header main nav ol section table ul"
).split()
# Block tags that end at the next block tag.
LEAVES = "html head title p pre li dd dt h1 h2 h3 h4 h5 h6 summary caption figcaption thead tbody tfoot tr td th".split()
# Elements dropped with their content, block tags included.
EMBEDDED = "button select textarea object svg video audio canvas iframe noscript template".split()

# Context columns: name and the tags they count.
TRACKED = {
    "article": ("article",),
    "nav": ("nav",),
    "footer": ("footer",),
    "aside": ("aside",),
    "form": ("form",),
    "header": ("header",),
    "table": ("table",),
    "list": ("ul", "ol", "dl"),
    "quote": ("blockquote",),
    "figure": ("figure",),
}

#: Stored bytes of pages for one partition.
PART_BYTES = 16 << 20

COMMENT = r"(?s)<!--.*?(?:-->|\z)|<\?.*?(?:>|\z)"
SCRIPT = r"(?is)<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)|<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)"
BLOCK_TAG = r"(?i)<(/?(?:" + "|".join(CONTAINERS + LEAVES) + r")(?:\s[^>]*|/)?>)"
LEAD = r"^<(/?)([A-Za-z][A-Za-z0-9]*)"
LEAD_TAG = r"^<[^>]*>"
EMBED = "(?is)" + "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in EMBEDDED)
# The patterns of noise as Spark runs them, the same but for their first character, which all alternatives share: only
# where it stands is one of them tried.
SPARK_COMMENT = r"(?s)<(?:!--.*?(?:-->|\z)|\?.*?(?:>|\z))"
SPARK_SCRIPT = r"(?is)<(script|style)(?:\s[^>]*)?>.*?(?:</\1\s*>|\z)"
SPARK_EMBED = "(?is)<(" + "|".join(EMBEDDED) + r")(?:\s[^>]*)?>.*?</\1\s*>"
LINE_BREAK = r"(?i)<(?:br|hr)(?:\s[^>]*|/)?>"
ANY_TAG = r"<[^>]*>"
LINK = r"(?is)<a(?:\s[^>]*)?>(.*?)(?:</a\s*>|\z)"
LINK_EVENT = r"(?i)(</?a(?:\s[^>]*)?>)"
TOKEN = r"<[^>]+>|[^<]+"
SHORT_LINK = 10
SHORT_LINK_PRECISE = 50


def attr_pattern(name: str) -> str:
    return rf"(?is)\s{name}\s*=\s*(?:\x22([^\x22]*)\x22|\x27([^\x27]*)\x27|([^\s\x22\x27>]+))"


def sql_attr(tag: str, name: str) -> str:
    """Value of an attribute of a raw tag, empty if absent."""
    # the values of attr_pattern in one group, so that a tag is searched once
    value = r"(?<=\x22)[^\x22]*(?=\x22)|(?<=\x27)[^\x27]*(?=\x27)|(?<![\x22\x27])[^\s\x22\x27>]+"
    pattern = rf"(?is)\s{name}\s*=\s*[\x22\x27]?({value})"
    return f"regexp_extract({tag}, {rx(pattern)}, 1)"


def sql_strip_noise(html: str) -> str:
    """HTML without comments, processing instructions, scripts and styles."""
    plain = f"regexp_replace(replace({html}, chr(30), ''), {rx(SPARK_COMMENT)}, '')"
    return f"regexp_replace({plain}, {rx(SPARK_SCRIPT)}, '')"


def page_parts(pages: DataFrame) -> int:
    """Partitions for the exchange of pages: the session's, or more if the files they come from ask for it.

    Only sizes of files count; the optimizer's guess for joins and checkpoints can be off by any factor.
    """
    leaves = pages._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    files = all(leaf.getClass().getSimpleName() == "LogicalRelation" for leaf in leaves)
    size = sum(leaf.stats().sizeInBytes() for leaf in leaves) if files else 0
    return max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def by_page(pages: DataFrame, *names: str) -> DataFrame:
    """The one exchange of the page operators: raw rows hashed on the page key.

    The partition count is given, because runtime coalescing would size partitions by the
    raw bytes, while the work and the rows grow many times in the explode that follows.
    """
    columns = dict.fromkeys(["page_id", "html", *names])
    return pages.select(*columns).repartition(page_parts(pages), "page_id")


def tokens(pages: DataFrame) -> DataFrame:
    """(page_id, pos, token, tag, kind): every tag and every text run of a page."""
    rows = pages.selectExpr(
        "page_id", f"posexplode(regexp_extract_all({sql_strip_noise('html')}, {rx(TOKEN)}, 0)) AS (pos, token)"
    )
    tag = f"lower(regexp_extract(token, {rx(LEAD)}, 2))"
    return rows.selectExpr(
        "page_id",
        "cast(pos as bigint) AS pos",
        "token",
        f"{tag} AS tag",
        f"""case when not startswith(token, '<') then 'text' when {tag} = '' then 'other'
            when startswith(token, '</') then 'close' else 'open' end AS kind""",
    )


def sql_cut(plain: str) -> str:
    """A page without noise (``sql_strip_noise``), cut before every block tag."""
    # embedded elements go before the cut, since they may hold block tags themselves
    plain = f"regexp_replace({plain}, {rx(SPARK_EMBED)}, '')"
    return f"split(regexp_replace({plain}, {rx(BLOCK_TAG)}, concat(chr(30), '<$1')), chr(30))"


def segments(pages: DataFrame) -> DataFrame:
    """(page_id, pos, tag, closing, open_tag, cls, inner_html): one row per block tag."""
    rows = by_page(pages).selectExpr("page_id", f"posexplode({sql_cut(sql_strip_noise('html'))}) AS (pos, seg)")
    led = rows.selectExpr(
        "page_id",
        "cast(pos as bigint) AS pos",
        f"lower(regexp_extract(seg, {rx(LEAD)}, 2)) AS tag",
        f"regexp_extract(seg, {rx(LEAD)}, 1) = '/' AS closing",
        f"regexp_extract(seg, {rx(LEAD_TAG)}, 0) AS open_tag",
        f"regexp_replace(seg, {rx(LEAD_TAG)}, '') AS inner_html",
    )
    names = f"lower(trim(concat({sql_attr('open_tag', 'class')}, ' ', {sql_attr('open_tag', 'id')})))"
    # Most block tags have no attributes; skip the attribute patterns for those.
    return led.selectExpr("*", f"case when closing or instr(open_tag, '=') = 0 then '' else {names} end AS cls")


OVER_PAGE = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
OVER_BEFORE = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
OVER_LEVEL = "OVER (PARTITION BY page_id, depth ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BY_POS = "OVER (PARTITION BY page_id ORDER BY pos)"


def with_context(segs: DataFrame) -> DataFrame:
    """Container depths per row; a stray end tag never pushes a depth below zero.

    Depth is the running sum of +1/-1 minus its running minimum, which is what a counter
    that ignores end tags at zero would show. All sums share one window and one sort.
    """
    groups = {"depth": tuple(CONTAINERS)} | {f"in_{k}": v for k, v in TRACKED.items()}
    sums = segs.selectExpr(
        "*",
        *[
            f"sum(case when tag in {sql_list(tags)} then case when closing then -1 else 1 end else 0 end) {OVER_PAGE} AS _s_{name}"
            for name, tags in groups.items()
        ],
        f"last_value(try_element_at(regexp_extract_all(inner_html, {rx(LINK_EVENT)}, 1), -1)) IGNORE NULLS {OVER_BEFORE} AS _link",
        f"max(tag = 'head') {OVER_PAGE} AS _head",
        f"max(tag = 'body' or (tag = 'head' and closing)) {OVER_PAGE} AS _past",
    )
    depths = sums.selectExpr(
        *segs.columns,
        *[f"_s_{n} - least(0, min(_s_{n}) {OVER_PAGE}) AS {n}" for n in groups],
        "_head and not _past AS in_head",
        "coalesce(_link not like '</%', false) AS in_link",
        "case when _link not like '</%' then _link end AS link_tag",
    )
    marked = depths.selectExpr(
        "*",
        f"tag in {sql_list(CONTAINERS)} and not closing AS opens",
        f"tag in {sql_list(CONTAINERS)} and closing and lag(depth, 1, 0) {BY_POS} > depth AS closes",
        f"case when in_table = 1 and lag(in_table, 1, 0) {BY_POS} = 0 then 1 else 0 end AS _table_start",
    )
    return marked.selectExpr(
        "*", f"case when in_table > 0 then sum(_table_start) {OVER_PAGE} else 0 end AS table_no"
    ).drop("_table_start")


def with_containers(ctx: DataFrame) -> DataFrame:
    """Add `container_id` (position of the innermost open container) and `parent_id`.

    The innermost container of a row at depth d is the last one opened at depth d. Its
    parent is the container of the row just before it opened. Any depth works.
    """
    return (
        ctx.selectExpr("*", f"coalesce(last_value(case when opens then pos end) IGNORE NULLS {OVER_LEVEL}, -1) AS container_id")
        .selectExpr("*", f"case when opens then lag(container_id, 1, -1) {BY_POS} end AS _up")
        .selectExpr("*", f"coalesce(last_value(_up) IGNORE NULLS {OVER_LEVEL}, -1) AS parent_id")
        .drop("_up")
    )


def sql_mark(df: DataFrame, flag: str | None, keep: str, **helpers: str) -> DataFrame:
    """Apply a row rule: narrow the boolean column ``flag``, or filter if none is named.

    ``helpers`` are columns computed before the rule; in both they see ``{on}``, the
    condition that a row is still in. Narrowing leaves the row stream whole, so several
    extractions can be carried over one pass.
    """
    on = flag or "true"
    if helpers:
        df = df.selectExpr("*", *[f"{e.replace('{on}', on)} AS {n}" for n, e in helpers.items()])
    rule = keep.replace("{on}", on)
    if flag is None:
        return df.where(rule).drop(*helpers)
    return df.withColumn(flag, F.expr(f"{flag} and coalesce({rule}, false)")).drop(*helpers)


def sql_inline_text(markup: str) -> str:
    """Text of inline markup: tags out, entities decoded, white space collapsed."""
    bare = f"regexp_replace(regexp_replace({markup}, {rx(LINE_BREAK)}, ' '), {rx(ANY_TAG)}, '')"
    return sql_trim_ws(sql_unescape(f"(case when instr({markup}, '<') > 0 then {bare} else {markup} end)"))


ROLE = """case when closing then 'div' when tag = 'p' then 'p' when tag in ('li', 'dd', 'dt') then 'item'
  when tag in ('h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'summary') then 'head' when tag in ('blockquote', 'pre') then 'quote'
  when tag in ('td', 'th') then 'cell' when tag in ('figcaption', 'caption') then 'caption' else 'div' end"""


# text before the first block tag, or right behind <html>, </head> and </html>, has no block tag of its own
LOOSE = f"tag in ('', 'html', 'head') and (tag <> 'head' or closing) and regexp_replace(inner_html, {rx(ANY_TAG)}, '') rlike r'\\S'"
IN_BODY = f"not in_head and (tag not in ('title', 'head', 'html', '') or ({LOOSE}))"


def blocks(ctx: DataFrame) -> DataFrame:
    """Text and link measures of every body row.

    A link left open by an earlier row is re-opened with its target, so its text still counts as link text.
    """
    body = ctx.where(IN_BODY)
    flow = "case when in_link then concat(link_tag, inner_html) else inner_html end"
    lens = f"transform(regexp_extract_all(flow, {rx(LINK)}, 1), t -> length({sql_inline_text('t')}))"
    return (
        body.selectExpr("*", f"{flow} AS flow", f"{ROLE} AS role")
        .selectExpr("*", f"{sql_inline_text('flow')} AS text", f"{lens} AS _lens")
        .selectExpr(
            "*",
            "length(text) AS text_len",
            "size(_lens) AS n_links",
            "size(filter(_lens, n -> n > 0)) AS n_named",
            "aggregate(_lens, 0, (a, n) -> a + n) AS link_len",
            f"size(filter(_lens, n -> n > 0 and n < {SHORT_LINK})) AS n_short",
            f"size(filter(_lens, n -> n > 0 and n < {SHORT_LINK_PRECISE})) AS n_short_precise",
        )
        .drop("_lens")
    )


def drop_containers(
    df: DataFrame, tables: bool = True, images: bool = False, flag: str | None = None
) -> DataFrame:
    """Rows outside navigation, footer, aside and form; tables and figures optional."""
    keep = "in_nav = 0 and in_footer = 0 and in_aside = 0 and in_form = 0"
    if not tables:
        keep += " and in_table = 0"
    if not images:
        keep += " and in_figure = 0"
    return sql_mark(df, flag, keep)


def drop_empty(df: DataFrame, flag: str | None = None) -> DataFrame:
    return sql_mark(df, flag, "text_len > 0")


def size_guard(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of pages with at most ``limit`` rows."""
    sized = rows.selectExpr("*", "count(1) OVER (PARTITION BY page_id) AS _n")
    return sized.where(f"_n <= {limit}").drop("_n")
