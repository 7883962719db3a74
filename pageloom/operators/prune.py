"""Section flags by class and id, and the rules that drop boilerplate rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pageloom.functions.text import rx, sql_list
from pageloom.operators.markup import OVER_PAGE, blocks, segments, sql_mark, with_containers, with_context


@dataclass(frozen=True)
class Rule:
    """A row starts a section if its tag fits and its names, or its raw tag, match."""

    tags: tuple[str, ...] = ()
    names: str = ""
    names_unless: str = ""
    raw: str = ""
    first_only: bool = False


SECTION_TAGS = ("article", "div", "main", "section")
LIST_TAGS = ("div", "ol", "ul", "dl", "section")

RULES: dict[str, Rule] = {
    "boilerplate": Rule(
        names=r"(^|[\s_-])(cookie|banner|breadcrumbs?|sidebar|widget|share|sharing|social|related|newsletter|promo|sponsor|sponsored|"
        r"advert|advertisement|ads?|menu|navigation|footer|hidden|login|popup|tags?)([\s_-]|$)",
        raw=r"(?i)\shidden[\s>=]|aria-hidden\s*=\s*.?true|display\s*:\s*none",
    ),
    "paywall": Rule(names=r"paywall|subscriber-only|premium-|metered"),
    "teaser": Rule(names=r"teaser|trending|recommend|most-read"),
    "caption": Rule(names=r"caption|image-credit|media-info"),
    "extras": Rule(names=r"(^|[\s_-])(bottom|links?|meta|toolbar)([\s_-]|$)"),
    "comment_area1": Rule(LIST_TAGS, r"(^|[\s_-])comment-(list|thread|page)", first_only=True),
    "comment_area2": Rule(LIST_TAGS, r"(^|\s)comments?([\s_-]|$)", first_only=True),
    "comment_area3": Rule(LIST_TAGS, r"disqus|discussion", first_only=True),
    "comment_area4": Rule(LIST_TAGS, r"comment", first_only=True),
    "comment_noise": Rule(names=r"comment-?(form|meta|reply)|respond|akismet"),
    "comments": Rule(names=r"comment|disqus"),
    "region1": Rule(
        SECTION_TAGS,
        r"(^|[\s_-])(post|entry|article|page|text|body)[_-]*(text|body|content|container|entry)",
        first_only=True,
    ),
    "region2": Rule(("article",), first_only=True),
    "region3": Rule(SECTION_TAGS, r"(^|[\s_-])(post|story|entry|blog|article)([\s_-]|$)", first_only=True),
    "region4": Rule(SECTION_TAGS, r"(^|[\s_-])(content|main)([\s_-]|$)", first_only=True),
    "region5": Rule(("main",), raw=r"(?i)\srole\s*=\s*.?main", first_only=True),
    "unlikely": Rule(
        names="|".join("advert aside breadcrumb comment cookie footer login menu navbar newsletter pagination popup related share sidebar subscribe toolbar widget".split()),
        names_unless="|".join("article content main post prose story".split()),
    ),
    "byline_noise": Rule(names=r"comment|related|sidebar|widget"),
    "footer_named": Rule(names=r"footer"),
    "topics": Rule(names=r"(^|[\s_-])(tags?|category|categories|topics?|meta|post-meta)([\s_-]|$)"),
}
BIT = {name: i for i, name in enumerate(RULES)}
REGIONS = [n for n in RULES if n.startswith("region")]
COMMENT_AREAS = [n for n in RULES if n.startswith("comment_area")]


def sql_starts(rule: Rule) -> str:
    parts = []
    if rule.names:
        named = f"cls rlike {rx(rule.names)}"
        parts.append(f"({named} and not cls rlike {rx(rule.names_unless)})" if rule.names_unless else named)
    if rule.raw:
        parts.append(f"open_tag rlike {rx(rule.raw)}")
    if rule.tags == ("main",):
        hit = f"(tag = 'main' or {parts[0]})"
    elif parts:
        hit = "(" + " or ".join(parts) + ")" + (f" and tag in {sql_list(rule.tags)}" if rule.tags else "")
    else:
        hit = f"tag in {sql_list(rule.tags)}"
    return f"{hit} and not closing"


def sql_mask(bits: dict[str, int]) -> str:
    """The rules a row matches, as a sum of their bits."""
    terms = {n: f"if({sql_starts(RULES[n])}, {1 << bit}L, 0L)" for n, bit in bits.items()}
    by_tag = [n for n in bits if not RULES[n].names]
    by_name = " + ".join(t for n, t in terms.items() if n not in by_tag) or "0L"
    # Rules on names look at rows with attributes only, a small share of all rows.
    return " + ".join([f"if(length(open_tag) > length(tag) + 2, {by_name}, 0L)", *[terms[n] for n in by_tag]])


def with_sections(ctx: DataFrame, *names: str) -> DataFrame:
    """Add ``in_<rule>`` (0 = outside) for the named rules, all by default.

    Each opening row carries the matching rules as a bit mask. The end row of a container
    takes the mask of the last container opened at its level, so a section is a running
    sum of +bit and -bit and works at any depth. `first_only` rules keep the first
    outermost section of the page.
    """
    rules = {n: RULES[n] for n in names or RULES}
    bits = {n: i for i, n in enumerate(rules)}
    first = [n for n, r in rules.items() if r.first_only]
    mask = sql_mask(bits)

    def bit(c: str, n: str) -> str:
        return f"(shiftright({c}, {bits[n]}) & 1)"

    ends = (
        "last_value(case when opens then _mask end) IGNORE NULLS OVER (PARTITION BY page_id, depth + cast(closes as int) "
        "ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    held = ctx.selectExpr("*", f"{mask} AS _mask").selectExpr("*", f"{ends} AS _end").selectExpr(
        "*",
        *[
            f"sum(case when opens then {bit('_mask', n)} when closes then -{bit('_end', n)} else 0 end) {OVER_PAGE} AS _h_{n}"
            for n in rules
        ],
    )
    ordered = held.selectExpr(
        "*",
        *[
            f"sum(case when opens and {bit('_mask', n)} = 1 and _h_{n} = 1 then 1 else 0 end) {OVER_PAGE} AS _o_{n}"
            for n in first
        ],
    )
    return ordered.selectExpr(
        *ctx.columns,
        *[
            f"case when _h_{n} > 0 and _o_{n} = 1 then 1 else 0 end AS in_{n}"
            if n in first
            else f"_h_{n} + case when opens or closing then 0 else {bit('_mask', n)} end AS in_{n}"
            for n in rules
        ],
    )


def drop_sections(df: DataFrame, *families: str, guard: bool = False, flag: str | None = None) -> DataFrame:
    """Drop rows inside the named sections.

    With the guard, a page keeps all its rows if at most 1/7 of its text would remain.
    """
    inside = "(" + " or ".join(f"in_{f} > 0" for f in families) + ")"
    if not guard:
        return sql_mark(df, flag, f"not {inside}")
    w = "OVER (PARTITION BY page_id)"
    return sql_mark(
        df,
        flag,
        f"not ({inside} and _left * 7 > _all)",
        _left=f"sum(case when {{on}} and not {inside} then text_len else 0 end) {w}",
        _all=f"sum(case when {{on}} then text_len else 0 end) {w}",
    )


def link_density_filter(
    df: DataFrame,
    roles: tuple[str, ...] = ("div", "p", "item"),
    precision: bool = False,
    flag: str | None = None,
) -> DataFrame:
    """Drop short rows whose links are most of it, mostly short, or all empty.

    A row counts as short below 25 characters for p (100 in precision mode), 300 for the
    last row of its container, otherwise 100.
    """
    short = "n_short"
    if precision:
        roles, short = (*roles, "head", "quote"), "n_short_precise"
    heavy = f"(n_named = 0 or link_len > 0.8D * text_len or {short} > 0.8D * n_named)"
    return sql_mark(
        df,
        flag,
        f"not (role in {sql_list(roles)} and n_links > 0 and text_len < _limit and {heavy})",
        _limit=f"case when role = 'p' then {100 if precision else 25} when lead(pos) OVER "
        "(PARTITION BY page_id, container_id, {on} ORDER BY pos) is null then 300 else 100 end",
    )


def repeated_links_filter(df: DataFrame, precision: bool = False, flag: str | None = None) -> DataFrame:
    """Drop div rows with links whose short text occurs three times on the page."""
    longest = (200 if precision else 100) - 1
    cand = f"({{on}} and role = 'div' and n_named > 0 and text_len between 1 and {longest})"
    return sql_mark(
        df, flag, f"not ({cand} and _n >= 3)", _n=f"count_if({cand}) OVER (PARTITION BY page_id, text)"
    )


def link_table_filter(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Drop the rows of long tables that are mostly links."""
    w = "OVER (PARTITION BY page_id, table_no)"
    sums = {"_size": "text_len", "_links": "n_links", "_named": "n_named", "_linked": "link_len"}
    heavy = (
        "table_no > 0 and _links > 0 and _size > 250 and (_named = 0 or (_size < 1000 and _linked > 0.8D * _size) "
        "or (_size > 1000 and _linked > 0.5D * _size))"
    )
    return sql_mark(
        df, flag, f"not ({heavy})", **{n: f"sum(case when {{on}} then {c} end) {w}" for n, c in sums.items()}
    )


# Lines that only name a sharing service or a page tool.
SERVICES = "bluesky facebook instagram linkedin mastodon pinterest reddit telegram threads tiktok twitter whatsapp xing youtube".split()
TOOLS = "copy link|download pdf|e-mail|email|pdf|print|save|send|share".split("|")
SHARE_LINE = r"(?i)^\W*((share|post|send|follow us|like) )?((on|via|by) )?(" + "|".join(SERVICES + TOOLS) + r")( (this|page|article))?\W*$"
HAS_WORD = r"[\p{L}\p{N}_]"


def text_filter(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Rows with a word character that are not a sharing line."""
    return sql_mark(df, flag, f"text rlike {rx(HAS_WORD)} and not text rlike {rx(SHARE_LINE)}")


def trim_tail(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Drop headings and rows that are nothing but links from the end of the page."""
    dangling = "(role = 'head' or (n_named > 0 and link_len >= text_len))"
    last = f"max(case when {{on}} and not {dangling} and text_len > 0 then pos end) OVER (PARTITION BY page_id)"
    return sql_mark(df, flag, "pos <= _last", _last=last)


def first_area(df: DataFrame, areas: list[str], least: int, name: str, flag: str | None = None) -> DataFrame:
    """Add ``name``: number of the first area rule with at least ``least`` rows of text."""
    on = flag or "true"
    found = ", ".join(
        f"case when count_if({on} and in_{a} > 0 and text_len > 0) OVER (PARTITION BY page_id) >= {least} then {i} end"
        for i, a in enumerate(areas, 1)
    )
    return df.selectExpr("*", f"coalesce({found}) AS {name}")


def sql_in_area(areas: list[str], name: str) -> str:
    inside = " ".join(f"when {i} then in_{a} > 0" for i, a in enumerate(areas, 1))
    return f"coalesce(case {name} {inside} end, false)"


def main_region(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Rows of the first region rule that yields more than one row with text.

    Adds ``region`` (1..5); pages without such a region have no rows in.
    """
    return sql_mark(first_area(df, REGIONS, 2, "region", flag), flag, sql_in_area(REGIONS, "region"))


def comment_rows(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Rows of the page's comment area, without forms, reply links and author lines.

    Adds ``comment_area`` (1..4), the first area rule that holds text.
    """
    quiet = "(in_comment_noise = 0 and text_len > 0)"
    found = first_area(df, COMMENT_AREAS, 1, "comment_area", quiet)
    return sql_mark(found, flag, f"{quiet} and {sql_in_area(COMMENT_AREAS, 'comment_area')}")


def page_blocks(pages: DataFrame, *rules: str) -> DataFrame:
    """segments -> context -> containers -> sections -> blocks, the start of every page query.

    Only the named section rules are computed; context columns nothing reads later are
    pruned from the windows by the optimizer.
    """
    tree = with_containers(with_context(segments(pages)))
    return blocks(with_sections(tree, *rules) if rules else tree)
