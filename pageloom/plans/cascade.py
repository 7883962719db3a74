"""The page cascade as one projection: a page is cut into rows, judged and put together inside its own row.

The rows come from one scan with a stack (``operators.pagerows``); everything later is a filter, a sum or a scan
over them. No row leaves its page, so there is no sort, no window and no exchange behind the one that spreads the pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pageloom.functions.text import rx, sql_list
from pageloom.operators import markup, paragraphs, prune, render, score
from pageloom.operators.inrow import bind, let, scan, staged, struct, total
from pageloom.operators.pagerows import PageRows

PARAGRAPH_LIKE = "role in ('p', 'quote')"
KNOWN_ROLES = "role in ('p', 'item', 'head', 'quote', 'cell', 'caption', 'div')"

RULES_USED = (
    "boilerplate", "paywall", "teaser", "caption", "extras", "comment_noise", "comments", "unlikely",
    *prune.REGIONS, *prune.COMMENT_AREAS,
)


@dataclass(frozen=True)
class Options:
    """Extraction options. ``min_size`` is the shortest text accepted without recovery."""

    min_size: int = 250
    precision: bool = False
    recall: bool = False
    tables: bool = False
    images: bool = False
    links: bool = True
    formatting: bool = True
    fallback: bool = True

    @property
    def paragraph_factor(self) -> int:
        return 5 if self.recall else 1 if self.precision else 3


# --- rows ---------------------------------------------------------------------------------------------------------

#: As ``score.sql_class_weight``, with each attribute read once, since nothing inside a lambda is shared.
_POINTS = [let("named", markup.sql_attr("open_tag", name), score.sql_name_points("named")) for name in ("class", "id")]
ROWS = PageRows(RULES_USED, {"class_weight": (f"case when instr(open_tag, '=') > 0 then {' + '.join(_POINTS)} else 0 end", "int")})
MEASURES = score.MEASURES | {"sentence": "text rlike r'\\.( |$)'", "wordy": f"text rlike {rx(prune.HAS_WORD)} and not text rlike {rx(prune.SHARE_LINE)}"}
SLIM = (
    "pos tag closing role class_weight in_nav in_footer in_aside in_form in_table in_figure opens closes closed table_no container_id parent_id ins "
    "text_len link_len n_links n_named n_short n_short_precise commas n_p n_li n_img n_input n_embed sentence wordy"
).split()
#: How rules and measures name the fields of a row.
FIELDS = ROWS.fields | {f: f"{{v}}.{f}" for f in (*SLIM, "rep")}


def on(sql: str, var: str = "r") -> str:
    return bind(sql, var, FIELDS)


# --- own extraction -----------------------------------------------------------------------------------------------


def _sum(items: str, what: str, where: str = "true") -> str:
    return total(items, "r", on(f"case when {where} then {what} else 0 end"))


def _keep(items: str, rule: str) -> str:
    return f"filter({items}, r -> coalesce({on(rule)}, false))"


def _first_area(items: str, areas: list[str], least: int, where: str) -> str:
    return "coalesce(" + ", ".join(f"case when size({_keep(items, f'{where} and in_{a} > 0 and text_len > 0')}) >= {least} then {i} end" for i, a in enumerate(areas, 1)) + ", 0)"


def _in_area(areas: list[str], number: str) -> str:
    return f"(case {number} " + " ".join(f"when {i} then in_{a} > 0" for i, a in enumerate(areas, 1)) + " else false end)"


def _without_link_rows(items: str, roles: tuple[str, ...], short: str = "n_short") -> str:
    """The link density rule; a row that ends its container may be longer."""
    last = let(
        "q",
        f"sort_array(transform({items}, (r, k) -> {struct(c='r.container_id', k='k')}))",
        "transform(filter(q, (e, j) -> j = size(q) - 1 or get(q, j + 1).c <> e.c), e -> e.k)",
    )
    heavy = f"(n_named = 0 or link_len > 0.8D * text_len or {short} > 0.8D * n_named)"
    limit = "case when r.role = 'p' then 25 when r.text_len < 100 then 100 when array_contains(l, k) then 300 else 100 end"
    rule = on(f"role in {sql_list(roles)} and n_links > 0 and text_len < 300 and {heavy}")
    return let("l", last, f"filter({items}, (r, k) -> not ({rule} and r.text_len < {limit}))")


def _without_repeats(items: str, precision: bool) -> str:
    longest = (200 if precision else 100) - 1
    cand = on(f"role = 'div' and n_named > 0 and text_len between 1 and {longest}")
    texts = f"sort_array(transform(filter({items}, r -> {cand}), r -> r.rep))"
    often = let("v", texts, "array_distinct(filter(v, (t, j) -> j >= 2 and get(v, j - 2) = t))")
    return let("o", often, f"filter({items}, r -> not ({cand} and array_contains(o, r.rep)))")


def _without_link_tables(items: str) -> str:
    zero = struct(t="0", size="0L", links="0L", named="0L", linked="0L")
    names = {"size": "text_len", "links": "n_links", "named": "n_named", "linked": "link_len"}
    step = struct(t="x.table_no", **{n: f"if(x.table_no = a.s.t, a.s.{n}, 0L) + x.{c}" for n, c in names.items()})
    sums = scan(f"filter({items}, r -> r.table_no > 0)", zero, step, "a.s", "struct<t:int,size:bigint,links:bigint,named:bigint,linked:bigint>")
    heavy = "e.links > 0 and e.size > 250 and (e.named = 0 or (e.size < 1000 and e.linked > 0.8D * e.size) or (e.size > 1000 and e.linked > 0.5D * e.size))"
    bad = let("v", sums, f"transform(filter(v, (e, j) -> (j = size(v) - 1 or get(v, j + 1).t <> e.t) and {heavy}), e -> e.t)")
    return let("o", bad, f"filter({items}, r -> not array_contains(o, r.table_no))")


def own_steps(o: Options) -> list[tuple[str, str]]:
    """From ``slim`` to ``pruned`` (what pruning leaves), ``own`` (the main region) and ``comments``."""
    quiet = "in_comment_noise = 0 and text_len > 0"
    clean = "in_nav = 0 and in_footer = 0 and in_aside = 0 and in_form = 0" + ("" if o.tables else " and in_table = 0") + ("" if o.images else " and in_figure = 0")
    in_area = _in_area(prune.COMMENT_AREAS, "area")
    families = ["paywall"] + ([] if o.images else ["caption"]) + ([] if o.recall else ["teaser"]) + (["extras", "comments"] if o.precision else [])
    roles, short = ("p", "item") + (("head", "quote") if o.precision else ()), "n_short"
    steps = [
        ("area", _first_area("slim", prune.COMMENT_AREAS, 1, quiet)),
        ("clean", _keep("slim", clean)),
        ("comments", _keep("clean", f"{quiet} and {in_area}")),
        ("p0", _keep("clean", f"not {in_area}")),
        ("p_all", _sum("p0", "text_len")),
        ("p_left", _sum("p0", "text_len", "in_boilerplate = 0")),
        ("p1", _keep("p0", "not (in_boilerplate > 0 and p_left * 7 > p_all)")),
        ("p2", _keep("p1", " and ".join(f"in_{f} = 0" for f in families))),
        ("p3", _without_link_rows("p2", ("div",))),
        ("p4", _without_repeats("p3", o.precision)),
        ("p5", _without_link_rows("p4", roles, short)),
        ("p6", _without_link_tables("p5") if o.tables or o.precision else "p5"),
        ("pruned", _keep("p6", "wordy")),
        ("p_chars", _sum("pruned", "text_len", "role = 'p'")),
        ("admitted", _keep("pruned", f"role <> 'div' or p_chars < {o.min_size * o.paragraph_factor}")),
        ("region", _first_area("admitted", prune.REGIONS, 2, "true")),
        ("inside", _keep("admitted", _in_area(prune.REGIONS, "region"))),
    ]
    dangling = "(role = 'head' or (n_named > 0 and link_len >= text_len))"
    wild = f"({PARAGRAPH_LIKE} or role = 'div')" if o.recall else PARAGRAPH_LIKE
    return steps + [
        ("last", f"coalesce(array_max(transform({_keep('inside', f'not {dangling} and text_len > 0')}, r -> r.pos)), -1)"),
        ("core", "filter(inside, r -> r.pos <= last)"),
        ("core_len", f"{_sum('core', 'text_len + 1')} - 1"),
        ("core_at", "transform(core, r -> r.pos)"),
        ("own", f"if(core_len < {o.min_size}, {_keep('pruned', f'{wild} or array_contains(core_at, pos)')}, core)"),
    ]


# --- scored extraction --------------------------------------------------------------------------------------------


def scored_steps(name: str, items: str, alive: str) -> list[tuple[str, str]]:
    """Rows of the article by container scores, as ``{name}`` from the rows ``items`` without those that are not ``alive``."""
    n = name
    sums = list(score.SUBTREE)
    kind = "struct<" + ",".join(f"{c}:bigint" for c in [*sums, "n_open"]) + ">"
    live = bind(alive, "x", FIELDS)
    step = struct(**{c: f"a.s.{c} + if({live}, x.{c}, 0)" for c in sums}, n_open="a.s.n_open + if(x.opens, 1, 0)")
    zero = struct(**{c: "0L" for c in [*sums, "n_open"]})
    before = scan(items, zero, step, "a.s", kind)
    # each closing row next to the opening row of its container, if that is there
    ends = (
        f"sort_array(concat(transform(filter(transform({items}, (r, k) -> {struct(key='r.pos', kind='1', at='k', opens='r.opens')}), e -> e.opens), e -> {struct(key='e.key', kind='1', at='e.at')}), "
        f"transform(filter(transform({items}, (r, k) -> {struct(key='r.closed', kind='0', at='k', closes='r.closes')}), e -> e.closes), e -> {struct(key='e.key', kind='0', at='e.at')})))"
    )
    pairs = let("v", ends, f"filter(transform(v, (e, j) -> {struct(kind='e.kind', at='e.at', till=f'if(j > 0 and get(v, j - 1).key = e.key, get(v, j - 1).at, size({items}))')}), e -> e.kind = 1)")
    row = f"get({items}, e.at)"
    parts = {f: f"{row}.{f}" for f in ("pos", "tag", "class_weight", "parent_id")}
    sub = {f"sub_{c}": f"get({n}_before, e.till).{c} - get({n}_before, e.at).{c}" for c in sums}
    containers = f"transform({n}_pairs, e -> {struct(at='e.at', till='e.till', opens='true', alive=bind(alive, row, FIELDS), **parts, **sub)})"

    half = "(100L * (2 + r.commas) + least(r.text_len, 300))"
    is_paragraph = on(f"({alive}) and ((tag in ('p', 'pre', 'td') and not closing) or role = 'div') and text_len >= {score.MIN_PARAGRAPH}")
    gifts = f"flatten(transform(filter({items}, r -> {is_paragraph}), r -> array({struct(key='r.container_id', kind='0', pts=f'2L * {half}')}, {struct(key='r.parent_id', kind='0', pts=half)})))"
    to = f"transform({n}_boxes, c -> {struct(key='c.pos', kind='1', pts='0L')})"
    run = scan("v", struct(key="-2", kind="0", pts="0L"), struct(key="x.key", kind="x.kind", pts="if(x.key = a.s.key, a.s.pts, 0L) + x.pts"), "a.s", "struct<key:int,kind:int,pts:bigint>")
    points = let("v", f"sort_array(concat({gifts}, {to}))", f"transform(filter({run}, e -> e.kind = 1), e -> e.pts)")
    density = "c.sub_link_len / greatest(c.sub_text_len, 1)"
    tag_points = bind(score.sql_tag_points(), "c", ["tag"])
    value = f"if(c.alive and get({n}_pts, k) > 0, (200 * (c.class_weight + {tag_points}) + get({n}_pts, k)) / 200D * (1 - {density}), cast(null as double))"
    fields = ["at", "till", "opens", "alive", "pos", "tag", "class_weight", "parent_id", *sub]
    scored = f"transform({n}_boxes, (c, k) -> {struct(**{f: f'c.{f}' for f in fields}, score=value)})"
    best = f"array_max(transform(filter({n}_scored, c -> c.score is not null), c -> {struct(s='c.score', n='-c.pos', up='c.parent_id')}))"
    picked = f"{n}_best is not null and (-{n}_best.n = c.pos or coalesce(c.parent_id = {n}_best.up and c.score >= greatest(10D, {n}_best.s * 0.2D), false))"

    # neighbours of a container that is empty but for pictures
    sizes = (
        f"filter(transform({items}, (r, k) -> {struct(f='if(r.opens, r.parent_id, r.container_id)', at='k', size=f'nullif(case when r.opens then get({n}_scored, cast(get({n}_before, k).n_open as int)).sub_text_len when not r.closing then r.text_len end, 0)')}), "
        "e -> e.size is not null)"
    )
    beside = f"filter({n}_sizes, e -> e.f = c.parent_id and e.at {{}} c.at)"
    reason_fields = {f: f"{{v}}.{f}" for f in [*fields, "score"]} | {
        "_prev_len": f"try_element_at({beside.format('<')}, -1).size",
        "_next_len": f"try_element_at({beside.format('>')}, 1).size",
    }
    reason = bind(score.sql_clean_reason(), "c", reason_fields)
    boxes = f"transform({n}_scored, c -> {struct(till='c.till', picked=picked, dropped=f'({reason}) is not null')})"
    # inside a picked container, and outside every dropped one
    box = f"get({n}_judged, cast(get({n}_before, a.s.at).n_open as int))"
    step = struct(
        at="a.s.at + 1",
        picked=f"if(x.opens and {box}.picked, greatest(a.s.picked, {box}.till), a.s.picked)",
        dropped=f"if(x.opens and {box}.dropped, greatest(a.s.dropped, {box}.till), a.s.dropped)",
    )
    flags = scan(items, struct(at="0", picked="0", dropped="0"), step, "a.s", "struct<at:int,picked:int,dropped:int>")
    loose = on(
        f"(tag = 'p' or (role = 'div' and closing)) and not opens and container_id = {n}_best.up and "
        "((text_len > 80 and link_len < 0.25D * text_len) or (text_len between 1 and 80 and link_len = 0 and sentence))"
    )
    quiet = on("in_form = 0 and not (role = 'head' and (class_weight < 0 or link_len > 0.33D * greatest(text_len, 1)))")
    kept = f"{bind(alive, 'r', FIELDS)} and r.text_len > 0 and (get({n}_flags, k + 1).picked > k or coalesce({loose}, false)) and {quiet} and get({n}_flags, k + 1).dropped <= k"
    return [
        (f"{n}_before", before),
        (f"{n}_pairs", pairs),
        (f"{n}_boxes", containers),
        (f"{n}_pts", points),
        (f"{n}_scored", scored),
        (f"{n}_best", best),
        (f"{n}_sizes", sizes),
        (f"{n}_judged", boxes),
        (f"{n}_flags", flags),
        (n, f"filter({items}, (r, k) -> {kept})"),
    ]


# --- classification -----------------------------------------------------------------------------------------------


def _nearest(items: str, **values: str) -> str:
    """For each item the last of each of the ``values`` of ``x`` before it that is not null, ``bad`` if none."""
    kind = "struct<" + ",".join(f"{n}:string" for n in values) + ">"
    return scan(items, struct(**{n: "'bad'" for n in values}), struct(**{n: f"coalesce({e}, a.s.{n})" for n, e in values.items()}), "a.s", kind)


def classified_steps(o: Options) -> list[tuple[str, str]]:
    """From ``rows`` and ``clean`` to ``good``, the rows that classification takes for text."""
    fields = {"class": "{v}.class", "_prev": "get(d0, k).decided", "_next": "get(d1, k).decided", "_prev_near": "get(d0, k).long", "_next_near": "get(d1, k).long"}
    stop_share = paragraphs.sql_stop_share("r.text")
    rule = bind(paragraphs.sql_class(), "r", FIELDS | {"stop_share": "share"})
    with_class = f"transform(cand, r -> {let('share', stop_share, struct(**{'pos': 'r.pos', 'text': 'r.text', 'text_len': 'r.text_len', 'class': rule}))})"
    both = lambda a, b, items, **values: [(a, _nearest(items, **values)), (b, f"reverse({_nearest(f'reverse({items})', **values)})")]
    first = bind(paragraphs.FIRST_PASS, "r", fields)
    last = bind(paragraphs.second_pass("get(s0, k).settled", "get(s1, k).settled"), "f", {"_first": "{v}"})
    clean = "in_nav = 0 and in_footer = 0 and in_aside = 0 and in_form = 0" + ("" if o.tables else " and in_table = 0") + ("" if o.images else " and in_figure = 0")
    return [
        ("cand", f"filter(rows, r -> {on(f'{clean} and in_paywall = 0 and in_comments = 0 and text_len > 0')})"),
        ("classed", with_class),
        *both("d0", "d1", "classed", decided="case when x.class in ('good', 'bad') then x.class end", long="case when x.class <> 'short' then x.class end"),
        ("firsts", f"transform(classed, (r, k) -> {first})"),
        *both("s0", "s1", "firsts", settled="case when x <> 'near' then x end"),
        ("finals", f"transform(firsts, (f, k) -> {last})"),
        ("good", "filter(classed, (r, k) -> get(finals, k) = 'good')"),
    ]


# --- the page -----------------------------------------------------------------------------------------------------


def _join(items: str, value: str, sep: str = "chr(10)") -> str:
    return f"array_join(transform({items}, r -> {value}), {sep})"


def _len(items: str) -> str:
    """Length of the rows' texts with a character between two of them."""
    return f"greatest({_sum(items, 'text_len + 1')} - 1, 0L)"


def sql_page(html: str, o: Options) -> tuple[list[tuple[str, str]], dict[str, str]]:
    """Steps over the page's rows, and what they give: row lists, lengths and texts by name."""
    longest = (200 if o.precision else 100) - 1
    slim = struct(at="k", **{f: f"r.{f}" for f in SLIM}, rep=f"if(r.role = 'div' and r.text_len between 1 and {longest}, r.text, cast(null as string))")
    steps = [
        ("segs", ROWS.segments(markup.sql_strip_noise(f"coalesce({html}, '')"))),
        ("rows", ROWS.rows(ROWS.context("segs"), MEASURES)),
        ("slim", f"transform(rows, (r, k) -> {slim})"),
        *own_steps(o),
        *scored_steps("strict", "slim", "in_paywall = 0 and in_unlikely = 0"),
        ("enough", f"{_sum('strict', 'text_len')} >= 250"),
        # the second round sees no rows where the first one found enough
        ("again", "if(enough, slice(slim, 1, 0), slim)"),
        *scored_steps("loose", "again", "in_paywall = 0"),
        ("scored", "if(enough, strict, loose)"),
    ]
    noise = "in_nav = 0 and in_footer = 0 and in_aside = 0 and in_form = 0"
    optional = ("" if o.tables else " and in_table = 0") + ("" if o.images else " and in_figure = 0")
    steps += [("scored_known", _keep("scored", f"{noise}{optional} and {KNOWN_ROLES}")), *classified_steps(o)]
    quiet = on("in_aside = 0 and in_footer = 0 and text_len > 0")
    line = render.sql_line("get(rows, r.at)", o.formatting, o.links, o.images)
    lines = lambda items: f"array_join(filter(transform({items}, r -> {line}), t -> t <> ''), chr(10))"
    paragraphs_of_own = _keep("own", "role = 'p'")
    values = {
        "own_text": lines("own"),
        "scored_text": lines("scored_known"),
        "good_text": _join("good", "r.text"),
        "comments": _join("comments", "get(rows, r.at).text"),
        "article_text": _join(f"filter(rows, r -> {quiet} and {on('in_region2 > 0')})", "r.text", "' '"),
        "paragraph_text": f"array_join(array_distinct(transform(filter(rows, r -> {quiet} and {on(PARAGRAPH_LIKE)}), r -> r.text)), chr(10))",
        "body_text": _join(f"filter(rows, r -> {quiet})", "r.text"),
        "own_len": _len("own"),
        "scored_len": _len("scored"),
        "plain_len": _len("scored_known"),
        "good_len": _len("good"),
        "own_p_len": _sum("own", "text_len", "role = 'p'"),
        "own_ps": f"cast(size({paragraphs_of_own}) as bigint)",
        "own_tables": "cast(size(array_distinct(transform(filter(own, r -> r.table_no > 0), r -> r.table_no))) as bigint)",
        "scored_noise": "cast(size(scored) - size(scored_known) as bigint)",
    }
    return steps, values


def with_page(pages: DataFrame, steps: list[tuple[str, str]], fields: dict[str, str], *keep: str) -> DataFrame:
    """The columns ``keep`` and the ``fields``, expressions in the steps, of every page: one projection over the spread pages."""
    return staged(markup.by_page(pages, *keep), steps, fields, *keep)
