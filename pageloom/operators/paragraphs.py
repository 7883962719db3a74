"""Paragraph classification by length, link share and stop-word share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pageloom.functions.stopwords import stop_words
from pageloom.functions.text import rx, sql_list

WORD = r"[\p{L}\p{N}_]+"
COPYRIGHT = r"©|\(c\)"
# Length limits, stop-word shares, link share.
SHORT, LONG = 50, 200
LOW_SHARE, HIGH_SHARE = 0.1, 0.2
MAX_LINK_SHARE = 0.2


def sql_stop_share(text: str, lang: str | None = None) -> str:
    """Share of stop words among the words of a text."""
    share = f"if(size(w) = 0, 0D, size(filter(w, t -> t in {sql_list(stop_words(lang))})) / size(w))"
    return f"transform(array(regexp_extract_all(lower({text}), {rx(WORD)}, 0)), w -> {share})[0]"


def sql_class(select: str = "select") -> str:
    """Class of a row with ``text``, ``text_len``, ``link_len``, ``stop_share`` and whether it holds a selection."""
    return f"""case when link_len > {MAX_LINK_SHARE}D * text_len then 'bad'
      when text rlike {rx(COPYRIGHT)} or {select} then 'bad'
      when text_len < {SHORT} then case when link_len > 0 then 'bad' else 'short' end
      when stop_share >= {HIGH_SHARE}D then case when text_len > {LONG} then 'good' else 'near' end
      when stop_share >= {LOW_SHARE}D then 'near' else 'bad' end"""


FIRST_PASS = """case when class <> 'short' then class when _prev = _next then _prev
  when (_prev = 'bad' and _prev_near = 'near') or (_next = 'bad' and _next_near = 'near') then 'good'
  else 'bad' end"""


def second_pass(before: str, after: str) -> str:
    return f"case when _first <> 'near' then _first when {before} = 'bad' and {after} = 'bad' then 'bad' else 'good' end"


def classify_blocks(df: DataFrame, lang: str | None = None) -> DataFrame:
    """Add ``class``: bad, short, near or good, for rows with text.

    The stop words are a short literal list, so the share is computed in place with a
    hash lookup per word; nothing is exploded or joined.
    """
    words = f"regexp_extract_all(lower(text), {rx(WORD)}, 0)"
    stops = f"size(filter(_words, w -> w in {sql_list(stop_words(lang))}))"
    rule = sql_class("instr(inner_html, '<select') > 0")
    return (
        df.selectExpr("*", f"{words} AS _words")
        .selectExpr("*", f"case when size(_words) = 0 then 0D else {stops} / size(_words) end AS stop_share")
        .selectExpr("*", f"{rule} AS class")
        .drop("_words")
    )


def revise_blocks(df: DataFrame) -> DataFrame:
    """Add ``final_class``: short and near rows take the class of their decided neighbours.

    Looks only at the nearest decided row on either side, found by a forward and a
    backward fill over the page. The edges of a page count as bad.
    """
    before = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"

    def nearest(expr: str, where: str) -> str:
        fill = "last_value" if where == before else "first_value"
        return f"coalesce({fill}({expr}) IGNORE NULLS {where}, 'bad')"

    decided = "case when class in ('good', 'bad') then class end"
    not_short = "case when class <> 'short' then class end"
    first = df.selectExpr(
        "*",
        f"{nearest(decided, before)} AS _prev",
        f"{nearest(decided, after)} AS _next",
        f"{nearest(not_short, before)} AS _prev_near",
        f"{nearest(not_short, after)} AS _next_near",
    ).selectExpr(
        "*",
        f"{FIRST_PASS} AS _first",
    )
    settled = "case when _first <> 'near' then _first end"
    return first.selectExpr(
        *df.columns,
        f"{second_pass(nearest(settled, before), nearest(settled, after))} AS final_class",
    )
