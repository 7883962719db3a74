"""The rows of a page as an array in the page's own row: one scan with a stack of open containers.

The scan carries depths, open containers and sections over the segments of a page, as windows over exploded rows
would with a sort for each; the rows, their text and their links are the same as those of ``prune.page_blocks``.
"""

from __future__ import annotations

from pageloom.functions.text import rx, sql_list
from pageloom.operators import markup, prune
from pageloom.operators.inrow import bind, let, lets, scan, struct

COUNTED = {f"in_{k}": v for k, v in markup.TRACKED.items()}
_STACK = "array<struct<pos:int,up:int,cum:bigint>>"
TREE = {
    "pos": "int", "tag": "string", "closing": "boolean", "inner_html": "string", **{n: "int" for n in COUNTED}, "link_tag": "string", "in_head": "boolean",
    "opens": "boolean", "closes": "boolean", "closed": "int", "table_no": "int", "container_id": "int", "parent_id": "int", "ins": "bigint",
}
#: Tags that change what is open around the rows after them.
CHANGING = tuple(dict.fromkeys([*markup.CONTAINERS, *[t for tags in COUNTED.values() for t in tags], "head"]))


class PageRows:
    """Body rows of a page for some section rules.

    ``carried`` names further fields with their SQL over ``tag``, ``closing``, ``open_tag`` and ``cls`` and their
    type. The fields ``in_<rule>`` and ``in_link`` are read through ``on``; sections are one number of bits. ``tree``
    are the fields of ``TREE`` that the rows have, all by default; the scan carries no others.
    """

    def __init__(self, rules: tuple[str, ...], carried: dict[str, tuple[str, str]], links: bool = True, tree: tuple[str, ...] = tuple(TREE)):
        self.bits = {name: i for i, name in enumerate(rules)}
        self.first = sum(1 << i for n, i in self.bits.items() if prune.RULES[n].first_only)
        self.carried, self.links, self.tree = carried, links, tree
        measured = ["flow", "role", "text", "text_len", "in_head", "link_tag", "select"]
        measured += ["n_links", "n_named", "link_len", "n_short", "n_short_precise"] if links else []
        self.fields = {f: f"{{v}}.{f}" for f in [*tree, *carried, *measured]}
        self.fields |= {f"in_{n}": f"(shiftright({{v}}.ins, {i}) & 1)" for n, i in self.bits.items()}
        self.fields["in_link"] = "({v}.link_tag is not null)"

    def on(self, sql: str, var: str = "r") -> str:
        return bind(sql, var, self.fields)

    def segments(self, plain: str) -> str:
        """Array of (tag, closing, inner_html, event, mask, carried fields), one for each block tag of a page without noise."""
        # a segment starts with its tag, but for the first one of a page, which may start with anything
        whole = "if(startswith(g, '<') and instr(g, '>') > 0, substring(g, 1, instr(g, '>')), '')"
        name = f"if(startswith(g, '<'), regexp_extract(if(whole_ = '', g, whole_), {rx(markup.LEAD)}, 0), '')"
        led = struct(tag="lower(translate(name_, '</', ''))", closing="startswith(name_, '</')", inner_html="substring(g, length(whole_) + 1)")
        names = f"lower(trim(concat({markup.sql_attr('whole_', 'class')}, ' ', {markup.sql_attr('whole_', 'id')})))"
        cls = f"if(g1.closing or instr(whole_, '=') = 0, '', {names})"
        event = f"if(instr(g1.inner_html, '<') > 0, try_element_at(regexp_extract_all(g1.inner_html, {rx(markup.LINK_EVENT)}, 1), -1), null)"
        columns = {"tag": "g1.tag", "closing": "g1.closing", "open_tag": "whole_", "cls": "cls_"}
        carried = {n: bind(e, "", columns) for n, (e, _) in self.carried.items()}
        masked = struct(tag="g1.tag", closing="g1.closing", inner_html="g1.inner_html", event=event, mask=bind(prune.sql_mask(self.bits), "", columns), **carried)
        # bound values, not one transform after the other, which would copy every segment each time
        bound = [("whole_", whole), ("name_", name), ("g1", led), ("cls_", cls)]
        return f"transform({markup.sql_cut(plain)}, g -> {lets(bound, masked)})"

    def context(self, segments: str) -> str:
        """The segments with what is open around them: the scan with the stack of containers.

        The scan goes over the segments that change what is open. The others take their context from the one before.
        """
        needs = [n for n in COUNTED if n in self.tree or (n == "in_table" and "table_no" in self.tree)]
        container = f"x.tag in {sql_list(markup.CONTAINERS)}"
        # without a link that its row leaves open no link tag is carried on, and no end of one counts
        link_open = f"exists({segments}, x -> x.event is not null and x.event not like '</%')"
        changes = f"k = 0 or x.tag in {sql_list(CHANGING)} or (link_open and x.event is not null)"
        item = struct(at="k", tag="x.tag", closing="x.closing", event="x.event", mask="x.mask", opening=f"{container} and not x.closing", ending=f"{container} and x.closing")
        items = let("link_open", link_open, f"filter(transform({segments}, (x, k) -> if({changes}, {item}, null)), x -> x is not null)")

        count = {n: f"if(x.tag in {sql_list(COUNTED[n])}, if(x.closing, greatest(a.s.{n} - 1, 0), a.s.{n} + 1), a.s.{n})" for n in needs}
        top = "try_element_at(a.s.stack, -1)"
        fresh = f"(x.mask & ~coalesce({top}.cum, 0L) & {self.first}L)"
        closes = "(x.ending and size(a.s.stack) > 0)"
        pushed = f"concat(a.s.stack, array({struct(pos='x.at', up=f'coalesce({top}.pos, -1)', cum=f'coalesce({top}.cum, 0L) | x.mask')}))"
        zero = {n: "0" for n in needs} | {"link": "cast(null as string)", "head": "false", "past": "false", "stack": f"cast(array() as {_STACK})"}
        step = count | {
            "link": "coalesce(x.event, a.s.link)",
            "head": "a.s.head or x.tag = 'head'",
            "past": "a.s.past or x.tag = 'body' or (x.tag = 'head' and x.closing)",
            "stack": f"if(x.opening, {pushed}, if({closes}, slice(a.s.stack, 1, size(a.s.stack) - 1), a.s.stack))",
        }
        now = "try_element_at(a.s.stack, -1)"
        cum = held = f"coalesce({now}.cum, 0L)"
        if self.first:
            zero |= {"seen": "0L", "over": "0L"}
            step |= {"seen": f"if(x.opening, a.s.seen | {fresh}, a.s.seen)", "over": f"if(x.opening, a.s.over | (a.s.seen & {fresh}), a.s.over)"}
            held = f"({cum} & ~{self.first}L) | ({cum} & a.s.seen & ~a.s.over & {self.first}L)"
        if "table_no" in self.tree:
            zero["table_no"] = "0"
            step["table_no"] = "a.s.table_no + if(x.tag = 'table' and not x.closing and a.s.in_table = 0, 1, 0)"
        # of the rows between two changing ones none opens or closes
        own = {"opens": ("x.opening", "boolean", "false"), "closes": (closes, "boolean", "false"), "closed": (f"if({closes}, {top}.pos, -1)", "int", "-1")}
        own = {n: v for n, v in own.items() if n in self.tree or n == "opens"}
        zero |= {n: rest for n, (_, _, rest) in own.items()}
        step |= {n: e for n, (e, _, _) in own.items()}
        emitted = {n: (f"a.s.{n}", "int") for n in COUNTED} | {
            "in_head": ("a.s.head and not a.s.past", "boolean"),
            "table_no": ("if(a.s.in_table > 0, a.s.table_no, 0)", "int"),
            "container_id": (f"coalesce({now}.pos, -1)", "int"),
            "parent_id": (f"coalesce({now}.up, -1)", "int"),
        }
        emitted = {n: v for n, v in emitted.items() if n in self.tree}
        states = emitted | {n: (f"a.s.{n}", kind) for n, (_, kind, _) in own.items()} | {"link": ("a.s.link", "string"), "held": (held, "bigint")}
        kind = "struct<" + ",".join(f"{n}:{t}" for n, (_, t) in states.items()) + ">"
        after = scan("changing", struct(**zero), struct(**step), struct(**{n: e for n, (e, _) in states.items()}), kind)

        row = {n: f"p.s.{n}" for n in emitted} | {n: f"if(j = 0, p.s.{n}, {rest})" for n, (_, _, rest) in own.items()} | {n: f"x.{n}" for n in ("tag", "closing", "inner_html")}
        row |= {"pos": "p.at + j", "link_tag": "if(j = 0, p.before, p.after)", "ins": f"p.s.held | if((j = 0 and p.s.opens) or x.closing, 0L, x.mask & ~{self.first}L)"}
        row = {n: row[n] for n in self.tree} | {n: f"x.{n}" for n in self.carried}
        links = {n: f"if(get(c, {k}).link like '</%', null, get(c, {k}).link)" for n, k in (("before", "n"), ("after", "n + 1"))} if "link_tag" in self.tree else {}
        piece = struct(at="i.at", s="get(c, n + 1)", **links)
        upto = f"coalesce(get(changing, n + 1).at, size({segments}))"
        rows = f"transform(slice({segments}, i.at + 1, {upto} - i.at), (x, j) -> {struct(**row)})"
        return let("changing", items, let("c", after, f"flatten(transform(changing, (i, n) -> {let('p', piece, rows)}))"))

    def rows(self, context: str, further: dict[str, str] | None = None, only: str = "true") -> str:
        """Body rows with text, links and the ``further`` fields, given as SQL over all fields before them.

        ``only`` is a rule for rows to go on with, over their context.
        """
        base = [n for n in [*self.tree, *self.carried] if n != "in_head"]
        flow = "case when r.link_tag is not null then concat(r.link_tag, r.inner_html) else r.inner_html end"
        with_flow = struct(**{n: f"r.{n}" for n in base}, flow=flow, role=self.on(markup.ROLE))
        lens = f"transform(regexp_extract_all(r1.flow, {rx(markup.LINK)}, 1), t -> length({markup.sql_inline_text('t')}))"
        known = [*base, "flow", "role"]
        lens = {"lens": f"if(instr(r1.flow, '<') > 0, {lens}, cast(array() as array<int>))"} if self.links else {}
        with_text = struct(**{n: f"r1.{n}" for n in known}, text=markup.sql_inline_text("r1.flow"), **lens)
        measured = {n: f"r2.{n}" for n in [*known, "text"] if n != "link_tag"} | {"text_len": "length(r2.text)", "select": "instr(r2.inner_html, '<select') > 0"}
        if self.links:
            measured |= {
                "n_links": "size(r2.lens)",
                "n_named": "size(filter(r2.lens, n -> n > 0))",
                "link_len": "aggregate(r2.lens, 0, (c, n) -> c + n)",
                "n_short": f"size(filter(r2.lens, n -> n > 0 and n < {markup.SHORT_LINK}))",
                "n_short_precise": f"size(filter(r2.lens, n -> n > 0 and n < {markup.SHORT_LINK_PRECISE}))",
            }
        last = struct(**{n: f"r3.{n}" for n in measured if n != "inner_html"}, **{n: self.on(e, "r3") for n, e in (further or {}).items()})
        body = f"filter({context}, r -> {self.on(f'({only}) and {markup.IN_BODY}')})"
        return f"transform({body}, r -> {let('r1', with_flow, let('r2', with_text, let('r3', struct(**measured), last)))})"
