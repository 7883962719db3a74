"""Joins of visits to stored responses, routing, and the error channel.

A row carries ``error`` and ``error_stage``; null means fine. Steps leave failed rows
untouched, and `split_results` parts the two at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import urls

VIDEO_ID = r"[?&]v=([A-Za-z0-9_-]+)"
# Routes by content type; anything else is an error.
HTML_TYPES = ("text/html", "application/xhtml+xml")
SALTS = 16


def with_error(df: DataFrame) -> DataFrame:
    """Add an empty error channel if there is none."""
    if "error" in df.columns:
        return df
    none = F.lit(None).cast("string")
    return df.withColumns({"error": none, "error_stage": none})


def fail_where(df: DataFrame, bad: Column, message: Column | str, stage: str) -> DataFrame:
    """Mark rows that meet ``bad``; rows that failed before keep their first error."""
    message = F.lit(message) if isinstance(message, str) else message
    df = with_error(df)
    hit = F.col("error").isNull() & F.coalesce(bad, F.lit(False))
    return df.withColumns(
        {
            "error_stage": F.when(hit, F.lit(stage)).otherwise(F.col("error_stage")),
            "error": F.when(hit, message).otherwise(F.col("error")),
        }
    )


def split_results(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    return df.where("error is null").drop("error", "error_stage"), df.where("error is not null")


def map_ok(value: Column) -> Column:
    """``value`` for rows without an error, null for the others."""
    return F.when(F.col("error").isNull(), value)


def or_else(value: Column, fallback: Column) -> Column:
    """``value`` for rows without an error, otherwise ``fallback``."""
    return F.when(F.col("error").isNull(), value).otherwise(fallback)


def expect(df: DataFrame) -> DataFrame:
    """Stop the job on the first failed row."""
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")).cast("string"))
    return df.withColumn("error", checked).where("error is null").drop("error", "error_stage")


def parse_visits(visits: DataFrame) -> DataFrame:
    """Raw visits with URL parts, kind, digest and normalised query; host-less rows fail."""
    u = F.col("url")
    parts = visits.withColumns(
        urls.url_parts(u) | {"digest": urls.url_digest(u), "kind": urls.url_kind(urls.hostname(u))}
    )
    return require_host(
        parts.withColumnRenamed("query", "query_raw").withColumn(
            "query", urls.strip_video_timestamp(urls.strip_tracking(F.col("query_raw")), F.col("kind"))
        )
    )


def require_host(df: DataFrame) -> DataFrame:
    return fail_where(df, F.col("hostname") == "", "No hostname found", "parse")


def unseen(visits: DataFrame, processed: DataFrame) -> DataFrame:
    """Visits whose raw URL is not processed yet.

    The processed side is reduced to distinct 16-byte digests. One URL may hold a third
    of the log, so visits are first collapsed to distinct digests for the look-up; only
    the unseen digests go back, salted, so no task has to take all visits of one URL.
    """
    seen = processed.select(F.md5("url").alias("_d")).distinct()
    keyed = visits.withColumn("_d", F.md5("url"))
    fresh = keyed.select("_d").distinct().join(seen, "_d", "left_anti")
    return salted_join(keyed, fresh, "_d", "left_semi").drop("_d")


def salted_join(big: DataFrame, unique: DataFrame, key: str, how: str, salts: int = SALTS) -> DataFrame:
    """Join a skewed side to a side with unique keys.

    Rows of one key spread over ``salts`` parts; each unique row is repeated that often.
    The salt is a hash of the row, so a task that runs again gives the same rows; runs of
    fully equal rows are left to the adaptive skew join.
    """
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    repeated = unique.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")


#: Visits of one URL that meet its response in one task.
HOT_VISITS = 1_000_000


def with_response(visits: DataFrame, archive: DataFrame, hot: int = HOT_VISITS) -> DataFrame:
    """Visits joined to their stored response, statuses 200-299 only.

    The visits of a URL are dealt over one part for each ``hot`` of them, and only the responses of such URLs are
    repeated, once for each part. Responses that nobody visited stay out of the join.
    """
    counts = visits.groupBy("url").agg(F.count("*").alias("_n")).where("url is not null")
    many = counts.where(F.col("_n") > hot).select("url", F.ceil(F.col("_n") / hot).cast("int").alias("_parts"))
    good = archive.where(F.col("status").between(200, 299)).join(counts.select("url"), "url", "left_semi")
    parts = F.coalesce("_parts", F.lit(1))
    repeated = good.join(many, "url", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    known = salted_join(visits, many, "url", "left")
    dealt = known.withColumn("_part", F.pmod(F.xxhash64(*visits.columns), parts).cast("int")).drop("_parts")
    return dealt.join(repeated, ["url", "_part"]).drop("_part")


def respond(visits: DataFrame, archive: DataFrame) -> DataFrame:
    """Like `with_response`, with missing and unsuccessful responses in the error channel."""
    joined = visits.join(archive, "url", "left")
    joined = fail_where(joined, F.col("status").isNull(), "No response", "fetch")
    return fail_where(joined, ~F.col("status").between(200, 299), "Unsuccessful response", "fetch")


def route(df: DataFrame) -> DataFrame:
    """Add ``route``: video or article; other content types fail as unsupported."""
    html = F.col("content_type").isin(*HTML_TYPES)
    routed = df.withColumn(
        "route",
        F.when((F.col("content_type") == HTML_TYPES[0]) & (F.col("kind") == "youtube"), "video").when(html, "article"),
    )
    message = F.concat(F.lit("Unsupported type "), F.col("content_type"))
    return fail_where(routed, F.col("route").isNull(), message, "route")


def video_id(url: Column) -> Column:
    """Video id in a URL, null if there is none."""
    return F.nullif(F.regexp_extract(url, VIDEO_ID, 1), F.lit(""))


def transcript_text(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Add ``transcript``: the text fragments of a transcript document, joined by blanks."""
    return df.withColumn("transcript", F.array_join(F.xpath(F.col(xml), F.lit("/*/text/text()")), " "))


def with_transcript(df: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Fill ``text`` from the transcript of the video; rows without one keep their text."""
    good = transcripts.where(F.col("status").between(200, 299)).select(
        F.col("video_id").alias("_vid"), "transcript"
    )
    keyed = df.withColumn("_vid", video_id(F.col("url")))
    # rows that are no video share no key, so they stay out of the join
    joined = keyed.where("_vid is not null").join(good, "_vid", "left")
    filled = joined.withColumn("text", F.coalesce("transcript", "text")).select(df.columns)
    return filled.unionByName(keyed.where("_vid is null").select(df.columns))


def require_text(df: DataFrame) -> DataFrame:
    return fail_where(df, F.coalesce(F.col("text"), F.lit("")) == "", "No text", "extract")
