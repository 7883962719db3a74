"""Queries over document texts: cleaning, fingerprints, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions import text
from pageloom.operators import dedup
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load


def d_trim_ws(c: str) -> str:
    return f"trim(regexp_replace({c}, '{text.SPACE_RUN}', ' ', 'g'))"


def d_unescape(c: str) -> str:
    number = "cast(case when lower(e[2]) = 'x' then '0x' || e[3:] else e[2:] end as int)"
    char_of = f"case when {number} between 1 and 55295 or {number} between 57344 and 1114111 then chr({number}) else chr(65533) end"
    found = f"list_filter(list_distinct(regexp_extract_all(x, '{text.NUMERIC}', 1)), lambda e: {number} <> 38)"
    steps = f"list_reduce(list_concat([x], {found}), lambda acc, e: replace(acc, '&' || e || ';', {char_of}))"
    c = f"list_transform([{c}], lambda x: case when contains(x, '&#') then {steps} else x end)[1]"
    for entity, char in text.ENTITIES:
        quoted = char.replace("'", "''")
        c = f"replace({c}, '{entity}', '{quoted}')"
    return c


def d_clean_line(c: str) -> str:
    c = f"replace(replace(replace({c}, '&#13;', chr(13)), '&#10;', chr(10)), '&nbsp;', chr(160))"
    return d_trim_ws(f"regexp_replace({c}, '{text.CONTROL}', '', 'g')")


def d_sanitize(c: str) -> str:
    return (
        f"array_to_string(list_filter(list_transform(regexp_split_to_array({c}, '\\r\\n|\\n|\\r'), "
        f"lambda x: {d_clean_line('x')}), lambda x: length(x) > 0), chr(10))"
    )


def d_fingerprint(c: str) -> str:
    return (
        f"to_base64(unhex(sha1(array_to_string(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]{{5,}}', 0), ' '))))"
    )


def d_strip_tags(c: str) -> str:
    return f"regexp_replace({c}, '(?s)<!--.*?-->|<[^>]*>', '', 'g')"


def d_reading_time(c: str) -> str:
    return f"cast(ceil(length({c}) / 5.0 / 250.0) as bigint) * 60"


def d_cap(c: str) -> str:
    cap = f"(case when length({c}) > 10000 then substr({c}, 1, 9999) || '…' else {c} end)"
    return f"nullif({d_clean_line(d_unescape(cap))}, '')"


cte("messy", "SELECT doc_id, '&nbsp; &#8217;&#X2014;&#xD800;&amp;#65;&ecirc;&Ntilde; ' || replace(text, '. ', '.' || chr(13) || chr(10) || chr(9) || chr(8203)) || ' &amp;lt; &#10; ' AS text FROM documents")


def messy(spark, sf_dir):
    broken = F.replace("text", F.lit(". "), F.lit(".\r\n\t​"))
    return load(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("&nbsp; &#8217;&#X2014;&#xD800;&amp;#65;&ecirc;&Ntilde; "), broken, F.lit(" &amp;lt; &#10; ")).alias("text")
    )


@query("trim_ws", "F1", f"SELECT doc_id, {d_trim_ws('text')} AS text FROM messy")
def q_trim_ws(spark, sf_dir):
    return messy(spark, sf_dir).select("doc_id", text.trim_ws(F.col("text")).alias("text"))


@query("sanitize", "F2", f"SELECT doc_id, {d_sanitize('text')} AS text FROM messy")
def q_sanitize(spark, sf_dir):
    return messy(spark, sf_dir).select("doc_id", text.sanitize(F.col("text")).alias("text"))


@query("normalize_nfc", "F3", "SELECT doc_id, nfc_normalize(replace(text, 'é', 'e' || chr(769))) AS text FROM documents")
def q_normalize_nfc(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", text.normalize_nfc(F.replace("text", F.lit("é"), F.lit("é"))).alias("text"))


@query("unescape", "F4", f"SELECT page_id, {d_unescape('html')} AS html FROM pages")
def q_unescape(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", text.unescape(F.col("html")).alias("html"))


@query("fingerprint", "F5", f"SELECT doc_id, {d_fingerprint('text')} AS fingerprint FROM documents")
def q_fingerprint(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", text.fingerprint(F.col("text")).alias("fingerprint"))


@query(
    "dedup_documents",
    "F6",
    f"SELECT doc_id, fingerprint FROM (SELECT doc_id, {d_fingerprint('text')} AS fingerprint, "
    f"row_number() OVER (PARTITION BY {d_fingerprint('text')} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
)
def q_dedup_documents(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return dedup.dedup_documents(docs, "doc_id", "text").select("doc_id", "fingerprint")


cte(
    "doc_segments",
    f"""SELECT doc_id, pos, case when pos % 11 = 7 then null else {d_trim_ws('seg')} end AS text FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS seg, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)""",
)


@query(
    "dedup_segments",
    "F7",
    """SELECT doc_id, cast(pos as bigint) AS pos, text FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id, pos) AS rn FROM doc_segments)
WHERE text is null OR length(text) < 10 OR rn <= 2""",
)
def q_dedup_segments(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    segs = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "seg"))
    segs = segs.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.when(F.col("pos") % 11 != 7, text.trim_ws(F.col("seg"))).alias("text"))
    return dedup.dedup_segments(segs, ["doc_id", "pos"], "text", max_repeats=2, min_len=10)


@query(
    "uniq_list",
    "F8",
    "SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(w), lambda x: "
    "lpad(cast(list_position(w, x) as varchar), 8, '0') || x)), lambda x: substr(x, 9)), ' ') AS words "
    "FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)",
)
def q_uniq_list(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(text.uniq(F.split("text", " ")), " ").alias("words"))


@query("cap_fields", "F9", f"SELECT doc_id, {d_cap('text')} AS text FROM documents")
def q_cap_fields(spark, sf_dir):
    return text.cap_fields(load(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query("strip_tags", "F10", f"SELECT page_id, {d_strip_tags('html')} AS text FROM pages")
def q_strip_tags(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query("reading_time", "D28", f"SELECT doc_id, {d_reading_time('text')} AS seconds FROM documents")
def q_reading_time(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", text.reading_time(F.col("text")).alias("seconds"))
