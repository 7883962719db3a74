"""Removal of duplicate documents and segments.

A copy group may hold a third of all rows, so no group is gathered or sorted in one
task: survivors are chosen by aggregates with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.text import fingerprint


def dedup_documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """Keep the lowest key of each fingerprint.

    ``min`` is combined on the map side, so copies collapse before the shuffle; the
    texts follow through a semi join on the unique key.
    """
    marked = df.withColumn("fingerprint", fingerprint(F.col(text)))
    keep = marked.groupBy("fingerprint").agg(F.min(key).alias(key)).select(key)
    return marked.join(keep, key, "left_semi")


def dedup_segments(df: DataFrame, order: list[str], text: str, max_repeats: int, min_len: int) -> DataFrame:
    """Keep the first ``max_repeats`` places of each segment text; short ones pass.

    The places kept of one text are the ``max_repeats`` smallest. Each map task first
    cuts its own rows to that many per text, which no other task can overrule, and the
    second cut sees at most that many rows per text and task.
    """
    # a null text is short
    long_enough = F.coalesce(F.length(text) >= min_len, F.lit(False))
    rank = [F.col(c) for c in order]
    digest = F.md5(F.col(text))
    keyed = df.where(long_enough).withColumn("_digest", digest)
    place = F.struct(*rank)
    salted = keyed.withColumn("_salt", F.pmod(F.xxhash64(*rank), F.lit(64)))
    part = Window.partitionBy("_digest", "_salt").orderBy(place)
    whole = Window.partitionBy("_digest").orderBy(place)
    kept = (
        salted.withColumn("_rn", F.row_number().over(part))
        .where(F.col("_rn") <= max_repeats)
        .withColumn("_rn", F.row_number().over(whole))
        .where(F.col("_rn") <= max_repeats)
        .select(*df.columns)
    )
    return df.where(~long_enough).unionByName(kept)
