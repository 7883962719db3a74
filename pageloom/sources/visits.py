"""Visit log source: tab-separated date, quality, url with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "date string, quality string, url string, _corrupt string"
OPTIONS = {
    "sep": "\t",
    "header": "true",
    "quote": "",
    "enforceSchema": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "ignoreTrailingWhiteSpace": "true",
    "ignoreLeadingWhiteSpace": "true",
}


def split_fields(raw: DataFrame) -> DataFrame:
    """Visits with an error channel; lines without exactly three fields fail."""
    bad = F.col("_corrupt").isNotNull() | F.col("url").isNull()
    return raw.select(
        "date",
        "quality",
        F.trim("url").alias("url"),
        F.when(bad, F.lit("Expected 3 fields")).alias("error"),
        F.when(bad, F.lit("read")).alias("error_stage"),
    )


def read_visits(spark: SparkSession, path: str) -> DataFrame:
    return split_fields(spark.read.schema(SCHEMA).options(**OPTIONS).csv(path))


def write_visits(df: DataFrame, path: str) -> None:
    df.select("date", "quality", "url").write.options(sep="\t", header="true", quote="").csv(path)
