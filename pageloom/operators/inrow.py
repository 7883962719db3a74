"""SQL text for work on arrays inside one row: bound values, bound fields, and scans that carry a state.

A page is one row. What would take a sort and a window per step over exploded rows is a filter, a sort of a
short array or a scan here, in one projection without an exchange.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LITERAL = re.compile(r"(r?'(?:[^'])*')")
#: A scan works in blocks of the root of the number of items, of this size at least.
BLOCK = 8


def bind(sql: str, var: str, fields) -> str:
    """The expression with every column of ``fields`` read from the lambda variable ``var``.

    ``fields`` is a list of names, or a dict from names to expressions in which ``{v}`` stands for the variable.
    String literals and function names stay.
    """
    to = fields if isinstance(fields, dict) else {f: f"{{v}}.{f}" for f in fields}
    name = re.compile(r"(?<![\w.])(" + "|".join(sorted(map(re.escape, to), key=len, reverse=True)) + r")\b(?!\s*\()")
    parts = _LITERAL.split(sql)
    return "".join(p if i % 2 else name.sub(lambda m: to[m[1]].replace("{v}", var), p) for i, p in enumerate(parts))


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once per row.

    The value is the start of a fold over nothing, the body its end: a ``transform`` would copy the body's result.
    """
    return f"aggregate(cast(array() as array<int>), {value}, ({name}, _i) -> {name}, {name} -> {body})"


def lets(steps: list[tuple[str, str]], body: str) -> str:
    """``body`` with all names bound, each to a value that may use those before it."""
    for name, value in reversed(steps):
        body = let(name, value, body)
    return body


def scan(items: str, zero: str, step: str, emit: str, kind: str) -> str:
    """The states of a fold over the items, as values of SQL type ``kind``: before each item, and after the last.

    ``step`` gives the next state from the item ``x`` and the state ``a.s``; ``emit`` the value of the state ``a.s``.
    So the value behind item k stands at k + 1. States must have the type of ``zero``.
    """
    value = f"cast({emit} as {kind})"
    # a fold copies its whole state with every item, and so all that was emitted before: blocks of the root of n items
    # bound this to the block's values for an item, and to all earlier values once for a block
    start = struct(s="w.s", b=f"cast(array() as array<{kind}>)")
    block = f"aggregate(slice(it, cast(bl as int) * bs + 1, bs), {start}, (a, x) -> {struct(s=step, b=f'concat(a.b, array({value}))')})"
    following = let("d", block, struct(s="d.s", o="concat(w.o, array(d.b))"))
    last = let("a", struct(s="w.s"), f"flatten(concat(w.o, array(array({value}))))")
    blocks = "if(size(it) > 0, sequence(0L, (size(it) - 1) div bs), cast(array() as array<bigint>))"
    run = f"aggregate({blocks}, {struct(s=zero, o=f'cast(array() as array<array<{kind}>>)')}, (w, bl) -> {following}, w -> {last})"
    return let("it", items, let("bs", f"greatest({BLOCK}, cast(sqrt(size(it)) as int))", run))


def total(items: str, var: str, amount: str, kind: str = "bigint") -> str:
    return f"aggregate({items}, cast(0 as {kind}), (t, {var}) -> t + cast({amount} as {kind}))"


def _names(exprs) -> set[str]:
    """All words of the expressions outside their string literals."""
    return set(re.findall(r"[A-Za-z_]\w*", " ".join("".join(_LITERAL.split(e)[::2]) for e in exprs)))


def staged(df: DataFrame, steps: list[tuple[str, str]], fields: dict[str, str], *keep: str, depth: int = 5) -> DataFrame:
    """The columns ``keep`` and the ``fields`` after all steps, each of which may use the names before it.

    The steps go into a chain of projections, ``depth`` a time, since the analyzer resolves one nested lambda per
    pass. Between them a single struct holds what is still needed; it is bound once per row, so that merging the
    projections repeats nothing. Steps that neither the fields nor a later step names are left out.
    """
    used = _names(fields.values())
    wanted = []
    for name, value in reversed(steps):
        if name in used:
            wanted.append((name, value))
            used |= _names([value])
    steps = wanted[::-1]
    chunks = [steps[i : i + depth] for i in range(0, len(steps), depth)]
    last = [("", e) for e in fields.values()]
    live: list[str] = []
    for i, chunk in enumerate(chunks):
        rest = [e for c in chunks[i + 1 :] for _, e in c] + [e for _, e in last]
        later = _names(rest)
        known = {n: f"u.{n}" for n in live}
        bound = [(n, bind(e, "u", known) if known else e) for n, e in chunk]
        names = [n for n, _ in chunk]
        kept = [n for n in [*live, *names] if n in later]
        body = lets(bound, struct(**{n: n if n in names else f"u.{n}" for n in kept}))
        df = df.selectExpr(*df.columns, f"{let('u', 'st_', body) if live else body} AS new_").select(*[c for c in df.columns if c != "st_"], F.col("new_").alias("st_"))
        live = kept
    known = {n: f"u.{n}" for n in live}
    done = let("u", "st_", struct(**{n: bind(e, "u", known) for n, e in fields.items()}))
    df = df.selectExpr(*keep, f"{done} AS out_")
    # a filter on what comes out must not be pushed below and repeat everything, which a generator prevents; it gets
    # the fields alone, since all that stands in its row is written out
    return df.selectExpr(*keep, "inline(array(out_))")
