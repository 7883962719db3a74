"""Check SQL for the page rows: seg -> ctx -> tree -> blk."""

from __future__ import annotations

from pageloom.operators import markup as m
from pageloom.operators import prune as pr
from pageloom.operators import render as rd
from pageloom.functions.urls import IMAGE_FILE
from pageloom.plans.registry import cte
from pageloom.plans.text_queries import d_sanitize, d_trim_ws, d_unescape


def d_attr(tag: str, name: str) -> str:
    p = m.attr_pattern(name)
    return "(" + " || ".join(f"regexp_extract({tag}, '{p}', {g})" for g in (1, 2, 3)) + ")"


def d_strip_noise(c: str) -> str:
    return (
        f"regexp_replace(regexp_replace(replace({c}, chr(30), ''), '{m.COMMENT}', '', 'g'), '{m.SCRIPT}', '', 'g')"
    )


def d_inline(c: str) -> str:
    return d_trim_ws(
        d_unescape(f"regexp_replace(regexp_replace({c}, '{m.LINE_BREAK}', ' ', 'g'), '{m.ANY_TAG}', '', 'g')")
    )


def tags(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def d_starts(rule) -> str:
    parts = []
    if rule.names:
        named = f"regexp_matches(cls, '{rule.names}')"
        parts.append(f"({named} and not regexp_matches(cls, '{rule.names_unless}'))" if rule.names_unless else named)
    if rule.raw:
        parts.append(f"regexp_matches(open_tag, '{rule.raw}')")
    if rule.tags == ("main",):
        hit = f"(tag = 'main' or {parts[0]})"
    elif parts:
        hit = "(" + " or ".join(parts) + ")" + (f" and tag in {tags(rule.tags)}" if rule.tags else "")
    else:
        hit = f"tag in {tags(rule.tags)}"
    return f"{hit} and not closing"


def pages_cte(prefix: str, source: str) -> None:
    """Register the chain of row tables over one page table under a name prefix."""
    cte(
        f"{prefix}seg",
        f"""
SELECT page_id, pos, lower(regexp_extract(seg, '{m.LEAD}', 2)) AS tag, regexp_extract(seg, '{m.LEAD}', 1) = '/' AS closing,
  regexp_extract(seg, '{m.LEAD_TAG}', 0) AS open_tag,
  case when regexp_extract(seg, '{m.LEAD}', 1) = '/' then '' else
    lower(trim({d_attr(f"regexp_extract(seg, '{m.LEAD_TAG}', 0)", "class")} || ' ' || {d_attr(f"regexp_extract(seg, '{m.LEAD_TAG}', 0)", "id")})) end AS cls,
  regexp_replace(seg, '{m.LEAD_TAG}', '') AS inner_html
FROM (SELECT page_id, unnest(parts) AS seg, generate_subscripts(parts, 1) - 1 AS pos FROM (
  SELECT page_id, string_split(regexp_replace(regexp_replace({d_strip_noise('html')}, '{m.EMBED}', '', 'g'), '{m.BLOCK_TAG}', chr(30) || '<\\1', 'g'), chr(30)) AS parts FROM {source}))
""",
    )
    groups = {"depth": m.CONTAINERS} | {f"in_{k}": v for k, v in m.TRACKED.items()}
    w = "OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING)"
    sums = ",\n  ".join(
        f"cast(sum(case when tag in {tags(t)} then case when closing then -1 else 1 end else 0 end) {w} as bigint) AS s_{n}"
        for n, t in groups.items()
    )
    depths = ",\n  ".join(f"s_{n} - least(0, min(s_{n}) {w}) AS {n}" for n in groups)
    cte(
        f"{prefix}ctx",
        f"""
SELECT *, case when in_table > 0 then cast(sum(table_start) {w} as bigint) else 0 end AS table_no FROM (
SELECT *, tag in {tags(m.CONTAINERS)} and not closing AS opens,
  tag in {tags(m.CONTAINERS)} and closing and lag(depth, 1, 0) OVER (PARTITION BY page_id ORDER BY pos) > depth AS closes,
  case when in_table = 1 and lag(in_table, 1, 0) OVER (PARTITION BY page_id ORDER BY pos) = 0 then 1 else 0 end AS table_start,
  has_head = 1 and past_head = 0 AS in_head, coalesce(prev_link not like '</%', false) AS in_link
FROM (SELECT *, {depths} FROM (SELECT *, {sums},
  last_value(regexp_extract_all(inner_html, '{m.LINK_EVENT}', 1)[-1] IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_link,
  max(case when tag = 'head' then 1 else 0 end) {w} AS has_head,
  max(case when tag = 'body' or (tag = 'head' and closing) then 1 else 0 end) {w} AS past_head
FROM {prefix}seg)))
""",
    )
    level = "OVER (PARTITION BY page_id, depth ORDER BY pos ROWS UNBOUNDED PRECEDING)"
    cte(
        f"{prefix}tree",
        f"""
SELECT *, coalesce(last_value(up IGNORE NULLS) {level}, -1) AS parent_id FROM (
SELECT *, case when opens then lag(container_id, 1, -1) OVER (PARTITION BY page_id ORDER BY pos) end AS up FROM (
SELECT *, coalesce(last_value(case when opens then pos end IGNORE NULLS) {level}, -1) AS container_id FROM {prefix}ctx))
""",
    )
    mask = " + ".join(f"case when {d_starts(r)} then {1 << pr.BIT[n]} else 0 end" for n, r in pr.RULES.items())

    def bit(c: str, n: str) -> str:
        return f"(({c} >> {pr.BIT[n]}) & 1)"

    held = ",\n  ".join(
        f"cast(sum(case when opens then {bit('rule_mask', n)} when closes then -{bit('end_mask', n)} else 0 end) {w} as bigint) AS h_{n}"
        for n in pr.RULES
    )
    first = [n for n, r in pr.RULES.items() if r.first_only]
    order = ",\n  ".join(
        f"sum(case when opens and {bit('rule_mask', n)} = 1 and h_{n} = 1 then 1 else 0 end) {w} AS o_{n}" for n in first
    )
    inside = ",\n  ".join(
        f"case when h_{n} > 0 and o_{n} = 1 then 1 else 0 end AS in_{n}"
        if n in first
        else f"h_{n} + case when opens or closing then 0 else {bit('rule_mask', n)} end AS in_{n}"
        for n in pr.RULES
    )
    cte(
        f"{prefix}sec",
        f"""
SELECT *, {inside} FROM (SELECT *, {order} FROM (SELECT *, {held} FROM (
SELECT *, last_value(case when opens then rule_mask end IGNORE NULLS) OVER (PARTITION BY page_id, depth + closes::int ORDER BY pos ROWS UNBOUNDED PRECEDING) AS end_mask
FROM (SELECT *, {mask} AS rule_mask FROM {prefix}tree))))
""",
    )
    cte(
        f"{prefix}blk",
        f"""
SELECT *, length(text) AS text_len, len(lens) AS n_links, len(list_filter(lens, lambda n: n > 0)) AS n_named,
  coalesce(cast(list_sum(lens) as bigint), 0) AS link_len,
  len(list_filter(lens, lambda n: n > 0 and n < {m.SHORT_LINK})) AS n_short,
  len(list_filter(lens, lambda n: n > 0 and n < {m.SHORT_LINK_PRECISE})) AS n_short_precise
FROM (SELECT *, {d_inline('flow')} AS text,
  list_transform(regexp_extract_all(flow, '{m.LINK}', 1), lambda t: length({d_inline('t')})) AS lens,
  case when closing then 'div' when tag = 'p' then 'p' when tag in ('li', 'dd', 'dt') then 'item'
    when tag in ('h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'summary') then 'head' when tag in ('blockquote', 'pre') then 'quote'
    when tag in ('td', 'th') then 'cell' when tag in ('figcaption', 'caption') then 'caption' else 'div' end AS role
FROM (SELECT *, case when in_link then prev_link || inner_html else inner_html end AS flow
  FROM {prefix}sec WHERE not in_head and (tag not in ('title', 'head', 'html', '') or (tag in ('', 'html', 'head') and (tag <> 'head' or closing)
    and regexp_matches(regexp_replace(inner_html, '{m.ANY_TAG}', '', 'g'), '\\S')))))
""",
    )


def d_image_src(t: str) -> str:
    lazy, src = d_attr(t, "data-src"), d_attr(t, "src")
    return (
        f"regexp_replace(case when regexp_matches({lazy}, '{IMAGE_FILE}') then {lazy} "
        f"when regexp_matches({src}, '{IMAGE_FILE}') then {src} end, '^//', 'http://')"
    )


def d_render_inline(c: str, images: bool = False) -> str:
    if images:
        img = f"regexp_extract(x, '{rd.LEAD_IMG}', 0)"
        shown = (
            f"'![' || trim({d_attr(img, 'title')} || ' ' || {d_attr(img, 'alt')}) || '](' || coalesce({d_image_src(img)}, '') || ')' "
            f"|| regexp_replace(x, '{rd.LEAD_IMG}', '')"
        )
        c = (
            f"array_to_string(list_transform(string_split(regexp_replace({c}, '(?i)<(img(?:\\s[^>]*)?>)', chr(30) || '<\\1', 'g'), chr(30)), "
            f"lambda x: case when {img} = '' then x else {shown} end), '')"
        )
    tag, words, rest = (f"regexp_extract(x, '{rd.LINK_PART}', {g})" for g in (1, 2, 3))
    href = d_attr(tag, "href")
    link = (
        f"case when {tag} = '' then x when {d_trim_ws(f"regexp_replace({words}, '{m.ANY_TAG}', '', 'g')")} = '' then {words} || {rest} "
        f"else '[' || {words} || ']' || case when {href} = '' then '' else '(' || {href} || ')' end || {rest} end"
    )
    c = (
        f"array_to_string(list_transform(string_split(regexp_replace({c}, '{rd.LINK_OPEN}', chr(30) || '<\\1', 'g'), chr(30)), "
        f"lambda x: {link}), '')"
    )
    for names, mark in rd.EMPHASIS:
        c = f"regexp_replace({c}, '{rd.emphasis_pattern(names)}', '{mark}\\1{mark}', 'g')"
    c = f"regexp_replace(regexp_replace({c}, '{m.LINE_BREAK}', chr(10), 'g'), '{m.ANY_TAG}', '', 'g')"
    return d_unescape(d_sanitize(c))


def d_render_line(images: bool = False) -> str:
    level = "repeat('=', case when regexp_matches(tag, '^h[1-6]$') then cast(substr(tag, 2, 1) as int) else 2 end)"
    return (
        "case when shown = '' then '' when role = 'item' then '- ' || shown when role = 'cell' then '|' || shown || '|' "
        f"when role = 'head' then {level} || ' ' || shown || ' ' || {level} else shown end"
    )


def d_render(source: str, images: bool = False) -> str:
    """Rendered text per page of a block relation."""
    return (
        f"SELECT page_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM (SELECT page_id, pos, {d_render_line()} AS line "
        f"FROM (SELECT *, {d_render_inline('flow', images)} AS shown FROM {source})) WHERE line <> '' GROUP BY page_id"
    )


pages_cte("", "rich_pages")
pages_cte("plain_", "pages")
