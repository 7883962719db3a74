"""Structured Streaming path: visit log -> response join -> extraction -> upsert."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pageloom.operators import routing
from pageloom.operators.blocks import drop_written, shuffles_dropped, written
from pageloom.plans.ingest import ingest_pages
from pageloom.session import ensure_checkpoint_dir
from pageloom.sources.archive import stored_digests, upsert_processed
from pageloom.sources.keyed import KeyedLog
from pageloom.sources.visits import OPTIONS, SCHEMA, split_fields


def stream_visits(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """New files of the visit log; a batch is bounded by its number of files."""
    raw = spark.readStream.schema(SCHEMA).options(**OPTIONS).option("maxFilesPerTrigger", files_per_batch).csv(path)
    return split_fields(raw)


def stream_unseen(visits: DataFrame) -> DataFrame:
    """First sight of each URL across all batches and restarts, kept in the query's state.

    The state holds one 16-byte digest per URL; each task first drops the repeats it sees.
    """
    return visits.where("error is null").withColumn("digest", F.md5("url")).dropDuplicates(["digest"])


def run_available(df: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    """Work off all files there are now, batch by batch, and stop."""
    query = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all new rows to a parquet folder and stop."""
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def first_sight(visits: DataFrame) -> DataFrame:
    """Like `stream_unseen`, with malformed lines kept: each different one passes once, on its way to quarantine."""
    line = F.md5(F.concat_ws("\t", "date", "quality", "url"))
    return visits.withColumn("digest", F.when(F.col("error").isNull(), F.md5("url")).otherwise(line)).dropDuplicates(["digest"])


def stream_extract(
    spark: SparkSession, visits: DataFrame, archive: DataFrame | KeyedLog, transcripts: DataFrame, store: str, quarantine: str, checkpoint: str
) -> StreamingQuery:
    """Visits -> store of page records by digest, and a quarantine folder for all other visits.

    Pages that the store holds already are not extracted again, even under a new checkpoint. A batch that runs twice
    changes nothing: it finds its pages in the store, and overwrites its own quarantine folder. With an indexed archive
    (``sources.archive.index_responses``) a batch opens the files that can hold its pages and no others. What a batch
    writes on its way is packed, and dropped at its end.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        made: list[DataFrame] = []
        done = written(ingest_pages(batch.drop("digest"), archive, transcripts, stored_digests(spark, store, batch), made=made), "records")
        good, bad = routing.split_results(done)
        if not good.isEmpty():
            upsert_processed(spark, good, store, "visit_date")
        rejected = bad.select("digest", "url", "visit_date", "visit_quality", "error", "error_stage")
        rejected.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        for rows in (*made, done):
            drop_written(rows)

    # the session of the query takes the setting over as it starts, so the shuffles of a batch go with it
    with shuffles_dropped(spark):
        return run_available(first_sight(visits), handle, checkpoint)


SEEN_SCHEMA = "digest string"


def seen_set(spark: SparkSession, path: str) -> KeyedLog:
    """The digests seen so far, as sorted runs with an index instead of state that grows with the stream."""
    return KeyedLog(spark, path, spark.createDataFrame([], SEEN_SCHEMA).schema, digits=1, file_rows=1_000_000)


def stream_seen(spark: SparkSession, visits: DataFrame, seen: KeyedLog, handle, checkpoint: str, runs: int = 50) -> StreamingQuery:
    """Give ``handle(fresh, name)`` the visits of each batch whose URL was in no batch before, one for each URL.

    What was seen lies in ``seen``, so neither the query's state nor a batch grows with the stream, and a new checkpoint
    goes on where the old one ended. ``handle`` must overwrite what it wrote under the same name: a batch is noted
    after it, and a noted batch is not handled again. After ``runs`` batches their runs are merged into one.
    """
    ensure_checkpoint_dir(spark)

    def work(batch: DataFrame, batch_id: int) -> None:
        owner = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        name = f"{uuid.uuid5(uuid.NAMESPACE_URL, owner).hex}-{batch_id}"
        if seen.has(name):
            return
        keyed = batch.where("error is null").withColumn("digest", F.md5("url"))
        # the first of equal URLs is chosen before the shuffle ends, so a URL that fills a third of the log costs a row per task
        one = keyed.groupBy("digest").agg(F.min(F.struct("date", "quality", "url")).alias("v")).select("digest", "v.*").checkpoint()
        fresh = one.join(seen.lookup(one), "digest", "left_anti").checkpoint()
        handle(fresh, name)
        seen.append(fresh.select("digest"), name)
        if len(seen.live()) > runs:
            seen.compact(lambda rows: rows.distinct())

    return run_available(visits, work, checkpoint)
