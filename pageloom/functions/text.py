"""Text column functions: white space, entities, fingerprints, lists."""

from __future__ import annotations

from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The entities that the check SQL replaces, `&amp;` last.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&#x27;", "'"),
    ("&#34;", '"'),
    ("&#38;", "&"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&laquo;", "«"),
    ("&raquo;", "»"),
    ("&lsquo;", "‘"),
    ("&rsquo;", "’"),
    ("&ldquo;", "“"),
    ("&rdquo;", "”"),
    ("&euro;", "€"),
    ("&auml;", "ä"),
    ("&ouml;", "ö"),
    ("&uuml;", "ü"),
    ("&szlig;", "ß"),
    *((f"&{name};", chr(code)) for name, code in sorted(name2codepoint.items()) if 0xC0 <= code <= 0xFF and name not in ("auml", "ouml", "uuml", "szlig")),
    ("&amp;", "&"),
)
# All named entities of HTML 4 but the blank and the ampersand, which have their own steps; built from the standard table.
NAMED = {name: chr(code) for name, code in sorted(name2codepoint.items()) if name not in ("amp", "nbsp")}
NAME = "&([A-Za-z][A-Za-z0-9]+);"
AMPERSAND = "&(?:amp|#38);"
# Numeric references; `#38` is left to the end with `&amp;`, so nothing is decoded twice.
NUMERIC = r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"

SPACE_RUN = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]+"
CONTROL = r"[\x00-\x08\x0e-\x1b\x7f-\x{84}\x{86}-\x{9f}\p{Cf}\p{Co}]"
LINE_END = r"\r\n|\n|\r"
LONG_WORD = r"[\p{L}\p{N}_]{5,}"
MAX_FIELD = 10000


def rx(pattern: str) -> str:
    """A regular expression as a raw SQL string literal."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# The sql_* builders return SQL text for `selectExpr`: one parsed expression instead of
# hundreds of Column calls where a rule is applied many times.
def sql_trim_ws(c: str) -> str:
    return f"trim(regexp_replace({c}, {rx(SPACE_RUN)}, ' '))"


def sql_unescape(c: str) -> str:
    """Decode entities; texts without an ampersand pass untouched."""
    number = "if(lower(substring(e, 2, 1)) = 'x', cast(conv(substring(e, 3), 16, 10) as int), cast(substring(e, 2) as int))"
    valid = f"({number} between 1 and 55295 or {number} between 57344 and 1114111)"
    char_of = f"if({valid}, decode(unhex(lpad(hex({number}), 8, '0')), 'UTF-32'), decode(unhex('0000FFFD'), 'UTF-32'))"
    found = f"filter(array_distinct(regexp_extract_all(x, {rx(NUMERIC)}, 1)), e -> {number} <> 38)"
    out = f"case when instr(x, '&#') > 0 then aggregate({found}, x, (acc, e) -> replace(acc, concat('&', e, ';'), {char_of})) else x end"
    known = f"map_from_arrays(split('{' '.join(NAMED)}', ' '), split('{' '.join(NAMED.values())}', ' '))"
    named = f"array_distinct(regexp_extract_all(y, {rx(NAME)}, 1))"
    out = f"transform(array(replace(replace({out}, '&nbsp;', ' '), '&apos;', chr(39))), y -> aggregate({named}, y, (acc, e) -> coalesce(replace(acc, concat('&', e, ';'), try_element_at({known}, e)), acc)))[0]"
    return f"transform(array({c}), x -> case when instr(x, '&') > 0 then regexp_replace({out}, {rx(AMPERSAND)}, '&') else x end)[0]"


def sql_clean_line(c: str) -> str:
    c = f"replace(replace(replace({c}, '&#13;', chr(13)), '&#10;', chr(10)), '&nbsp;', chr(160))"
    return sql_trim_ws(f"regexp_replace({c}, {rx(CONTROL)}, '')")


def sql_sanitize(c: str) -> str:
    lines = f"transform(split({c}, {rx(LINE_END)}), line -> {sql_clean_line('line')})"
    return f"array_join(filter({lines}, line -> line <> ''), chr(10))"


def sql_first_of(*cols: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(trim({c}), '')" for c in cols) + ")"


def sql_reading_time(c: str) -> str:
    return f"cast(ceil(length({c}) / 5 / 250) as bigint) * 60"


def sql_fingerprint(c: str) -> str:
    return f"base64(unhex(sha1(array_join(regexp_extract_all(lower({c}), {rx(LONG_WORD)}, 0), ' '))))"


def trim_ws(c: Column) -> Column:
    """Collapse every run of white space to one blank and trim."""
    return F.trim(F.regexp_replace(c, SPACE_RUN, " "))


def unescape(c: Column) -> Column:
    """Decode named entities and numeric references, each once."""
    bound = F.transform(F.array(c), lambda x: x)
    return F.transform(bound, lambda x: F.when(F.instr(x, "&") > 0, _decoded(x)).otherwise(x))[0]


def _decoded(x: Column) -> Column:
    def code(e: Column) -> Column:
        hexadecimal = F.lower(F.substring(e, 2, 1)) == "x"
        return F.when(hexadecimal, F.conv(F.substring(e, F.lit(3), F.lit(9)), 16, 10).cast("int")).otherwise(F.substring(e, F.lit(2), F.lit(9)).cast("int"))

    def char_of(e: Column) -> Column:
        valid = code(e).between(1, 55295) | code(e).between(57344, 1114111)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code(e)), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))

    found = F.filter(F.array_distinct(F.regexp_extract_all(x, F.lit(NUMERIC), F.lit(1))), lambda e: code(e) != 38)
    x = F.aggregate(found, x, lambda acc, e: F.replace(acc, F.concat(F.lit("&"), e, F.lit(";")), char_of(e)))
    x = F.replace(F.replace(x, F.lit("&nbsp;"), F.lit(" ")), F.lit("&apos;"), F.lit("'"))
    known = F.map_from_arrays(F.split(F.lit(" ".join(NAMED)), " "), F.split(F.lit(" ".join(NAMED.values())), " "))
    named = lambda y: F.aggregate(
        F.array_distinct(F.regexp_extract_all(y, F.lit(NAME), F.lit(1))),
        y,
        lambda acc, e: F.coalesce(F.replace(acc, F.concat(F.lit("&"), e, F.lit(";")), F.try_element_at(known, e)), acc),
    )
    return F.regexp_replace(F.transform(F.array(x), named)[0], AMPERSAND, "&")


def clean_line(c: Column) -> Column:
    """One line: space entities, control characters, white space."""
    c = F.replace(c, F.lit("&#13;"), F.lit("\r"))
    c = F.replace(c, F.lit("&#10;"), F.lit("\n"))
    c = F.replace(c, F.lit("&nbsp;"), F.lit(" "))
    return trim_ws(F.regexp_replace(c, CONTROL, ""))


def sanitize(c: Column) -> Column:
    """Clean line by line and drop the lines that end up empty."""
    lines = F.transform(F.split(c, LINE_END), clean_line)
    return F.array_join(F.filter(lines, lambda line: F.length(line) > 0), "\n")


@F.pandas_udf(StringType())
def normalize_nfc(s: pd.Series) -> pd.Series:
    """Unicode normal form C; Spark has no built-in for it."""
    return s.str.normalize("NFC")


def fingerprint(c: Column) -> Column:
    """base64(SHA-1) over the lower-cased words of five characters and more."""
    words = F.regexp_extract_all(F.lower(c), F.lit(LONG_WORD), F.lit(0))
    return F.base64(F.unhex(F.sha1(F.array_join(words, " "))))


def uniq(c: Column) -> Column:
    """Unique items in order of first appearance."""
    return F.array_distinct(c)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<!--.*?-->|<[^>]*>", "")


def cap_field(c: Column) -> Column:
    """Cap at 10,000 characters with an ellipsis, decode, clean; empty is null."""
    capped = F.when(
        F.length(c) > MAX_FIELD, F.concat(F.substring(c, 1, MAX_FIELD - 1), F.lit("…"))
    ).otherwise(c)
    return F.nullif(clean_line(unescape(capped)), F.lit(""))


def cap_fields(df, *names: str):
    return df.withColumns({n: cap_field(F.col(n)) for n in names})


def normalize_tags(c: Column) -> Column:
    """Decode, trim, drop quotes, re-join the non-empty tags."""
    plain = F.regexp_replace(trim_ws(unescape(c)), "[\"']", "")
    return F.array_join(F.filter(F.split(plain, ", "), lambda t: t != ""), ", ")


def first_of(*cols: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def reading_time(c: Column) -> Column:
    """Seconds to read a text: five letters a word, 250 words a minute, whole minutes."""
    return F.ceil(F.length(c) / F.lit(5) / F.lit(250)).cast("bigint") * F.lit(60)
