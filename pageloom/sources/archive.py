"""Archive of stored responses and the processed-page store."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pageloom.sources.keyed import KeyedLog

ARCHIVE_SCHEMA = """
url struct<raw: string, quality: string, date: string, scheme: string, netloc: string, path: string, query: string, hostname: string>,
content struct<host: string, request_headers: map<string,string>, request_method: string, request_real_url: string, request_url: string,
  response_charset: string, response_content: string, response_content_type: string, response_headers: map<string,string>,
  response_real_url: string, response_status: int, response_url: string>
"""
PAGE_SCHEMA = """
url string, visit_date string, visit_kind string, text string, title string, duration int, author string, date string, image string,
tags array<string>, neighbors array<string>, categories array<string>, comments array<string>, _corrupt string
"""
# Python names of declared charsets; any other name is looked up as it is, unknown ones count as UTF-8.
# Without a byte order mark UTF-16 and UTF-32 are big-endian.
CHARSETS = {"utf-16": "utf-16-be", "utf-32": "utf-32-be"}
MARKS = {"utf-16": (b"\xff\xfe", b"\xfe\xff"), "utf-32": (b"\xff\xfe\x00\x00", b"\x00\x00\xfe\xff")}


def read_archive(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON archive documents; the body becomes binary.

    One document per line by default, so files split; ``multi_line`` reads indented documents, one file per task.
    """
    raw = spark.read.schema(ARCHIVE_SCHEMA).option("multiLine", str(multi_line).lower()).json(path)
    return raw.withColumn(
        "content", F.col("content").withField("response_content", F.unbase64("content.response_content"))
    )


def archive_json(df: DataFrame) -> DataFrame:
    """Archive rows as JSON strings with a base64 body."""
    body = F.col("content").withField("response_content", F.base64("content.response_content"))
    return df.select(F.to_json(F.struct("url", body.alias("content"))).alias("value"))


def write_archive(df: DataFrame, path: str, as_json: bool = False) -> None:
    """Parquet with a binary body, or JSON with a base64 body."""
    if as_json:
        archive_json(df).write.text(path)
    else:
        df.write.parquet(path)


def _decoded(raw: bytes, name: str) -> str:
    marked = any(raw.startswith(m) for m in MARKS.get(name, ()))
    try:
        return raw.decode(name if marked else CHARSETS.get(name, name), "replace")
    except LookupError:
        return raw.decode("utf-8", "replace")


@F.pandas_udf(StringType())
def _decode_other(body: pd.Series, name: pd.Series) -> pd.Series:
    """Bodies of other charsets than UTF-8; Spark's own decoder stops at the first broken byte."""
    return pd.Series([None if raw is None else _decoded(bytes(raw), n) for raw, n in zip(body, name)], dtype=object)


def decode_body(body: Column, charset: Column) -> Column:
    """Body as text: declared charset, UTF-8 by default; broken bytes become U+FFFD and never stop the job."""
    name = F.lower(F.trim(F.coalesce(charset, F.lit("utf-8"))))
    plain = name.isin("utf-8", "utf8", "")
    other = _decode_other(F.when(~plain, body.cast("binary")), name)
    return F.when(plain, F.make_valid_utf8(body.cast("string"))).otherwise(other)


def read_processed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Processed page documents; unreadable ones are skipped.

    One document per line by default; ``multi_line`` reads files that hold one indented document or an array of them.
    """
    raw = (
        spark.read.schema(PAGE_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("multiLine", str(multi_line).lower())
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
    )
    return raw.where("_corrupt is null and url is not null").drop("_corrupt")


def latest(df: DataFrame, *order: str) -> DataFrame:
    """Last version of each digest. Versions are cut per salt first, so a URL with very
    many versions is never ranked by one task alone."""
    # Equal versions are told apart by a hash, so a task that runs again picks the same row.
    rank = [F.col(c).desc() for c in (order or ("visit_date",))] + [F.xxhash64(*df.columns)]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(32)))
    for keys in (("digest", "_salt"), ("digest",)):
        w = Window.partitionBy(*keys).orderBy(*rank)
        salted = salted.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return salted.drop("_salt")


def store_of(spark: SparkSession, path: str, schema: StructType) -> KeyedLog:
    """The store of processed pages at ``path``: a log of versions keyed by digest."""
    return KeyedLog(spark, path, schema)


def upsert_processed(spark: SparkSession, new: DataFrame, path: str, *order: str) -> None:
    """Add the batch's last version of each digest to the store at ``path``.

    A batch writes its own rows and no others, and one rename makes them visible all at once. `read_store` shows the
    last version of each digest, `compact_store` drops the others. A batch that runs twice adds equal versions, which
    reading treats as one. Pages without text are refused by the caller's error channel.
    """
    store_of(spark, path, new.schema).append(latest(new, *order))


def read_store(spark: SparkSession, path: str, schema: StructType, *order: str) -> DataFrame:
    """The last version of each digest, of the versions there are now; a store that was never written is empty."""
    return latest(store_of(spark, path, schema).read(), *order)


def stored_digests(spark: SparkSession, path: str, among: DataFrame) -> DataFrame:
    """Those of the digests ``among`` that the store holds; only their files are opened, and only that column is read."""
    return store_of(spark, path, StructType([StructField("digest", StringType())])).lookup(among)


def compact_store(spark: SparkSession, path: str, schema: StructType, *order: str) -> None:
    """Rewrite the store without superseded versions; readers and appends go on meanwhile."""
    store_of(spark, path, schema).compact(lambda rows: latest(rows, *order))


RESPONSE_SCHEMA = "digest string, url string, status int, content_type string, html string"


def index_responses(spark: SparkSession, responses: DataFrame, path: str) -> KeyedLog:
    """Stored responses (url, status, content_type, html) laid out by digest of the URL, with an index of their files."""
    found = KeyedLog(spark, path, spark.createDataFrame([], RESPONSE_SCHEMA).schema)
    found.append(responses.withColumn("digest", F.md5("url")).withColumn("status", F.col("status").cast("int")))
    return found


def delete_processed(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Store rows without the given digests."""
    return df.join(keys.select("digest").distinct(), "digest", "left_anti")


def export_json(df: DataFrame, path: str) -> None:
    """JSON export; an empty export is refused."""
    if df.isEmpty():
        raise ValueError(f"nothing to write to {path}")
    df.write.json(path)


# Field names of the JSON document form.
RENAMED = {"url": "source", "sitename": "source-hostname", "description": "excerpt"}


def to_json_doc(df: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, doc): rows as JSON with renamed fields and ``;``-joined lists."""
    lists = [f.name for f in df.schema if f.dataType.typeName() == "array"]
    flat = df.withColumns({n: F.array_join(n, ";") for n in lists}).withColumnsRenamed(RENAMED)
    fields = [F.col(f"`{c}`") for c in flat.columns if c != key]
    return flat.select(key, F.to_json(F.struct(*fields)).alias("doc"))


def write_xml(df: DataFrame, path: str) -> None:
    """XML documents: metadata columns as attributes, text columns as elements, empty ones left out."""
    texts = [c for c in ("text", "comments") if c in df.columns]
    flat = df.withColumns({n: F.array_join(n, ";") for n, t in df.dtypes if t.startswith("array")})
    named = flat.select(
        *[F.col(c).alias(f"_{c}") for c in df.columns if c not in texts],
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in texts],
    )
    named.write.format("xml").option("rootTag", "docs").option("rowTag", "doc").save(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, value): whole text files; ``.gz`` is decompressed by its extension."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
