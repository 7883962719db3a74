"""Queries of the ingest plan, in one batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators import routing
from pageloom.plans import ingest
from pageloom.plans.corpus_queries import visit_folder
from pageloom.plans.flow_queries import D_TRANSCRIPT
from pageloom.plans.meta_queries import d_duration_of_videos
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load
from pageloom.plans.url_queries import d_host, d_kind
from pageloom.session import work_path
from pageloom.sources import archive as ar
from pageloom.sources import visits as vs
from pageloom.streaming import visits as st

# Stored responses: the rich pages under their URL, and a video page under each video visit.
RESPONSES = """SELECT r.url, a.status, a.content_type, r.html, r.page_id FROM {rich_pages} r JOIN {archive} a ON a.url = r.url
UNION ALL SELECT v.url, 200, 'text/html', p.html, v.page_id FROM {visits} v JOIN {video_pages} p ON p.page_id = v.page_id WHERE v.page_id % 12 = 1"""
NAMES = ("rich_pages", "archive", "visits", "video_pages")
cte("responses", RESPONSES.format(**{n: n for n in NAMES}))
GOOD = "not (page_id % 7 = 3 or page_id % 9 = 4)"
cte(
    "ingested",
    f"""SELECT md5(v.url) AS digest, v.url, v.date AS visit_date, {d_kind(d_host('v.url'))} AS visit_kind, r.page_id,
  case when {d_host('v.url')} = '' then 'No hostname found' when r.status is null then 'No response' when r.status not between 200 and 299 then 'Unsuccessful response'
    when r.content_type not in ('text/html', 'application/xhtml+xml') then 'Unsupported type ' || r.content_type
    when coalesce(case when {d_kind(d_host('v.url'))} = 'youtube' then t.text else e.text end, '') = '' then 'No text' end AS error,
  case when {d_kind(d_host('v.url'))} = 'youtube' then t.text else e.text end AS text,
  case when {d_kind(d_host('v.url'))} = 'youtube' then 'Video ' || r.page_id end AS video_title,
  case when {d_kind(d_host('v.url'))} = 'youtube' then {d_duration_of_videos('r.page_id')} end AS duration
FROM (SELECT url, max(date) AS date FROM visits WHERE {GOOD} GROUP BY url) v LEFT JOIN responses r ON r.url = v.url
LEFT JOIN extracted e ON e.page_id = r.page_id
LEFT JOIN (SELECT video_id, {D_TRANSCRIPT} AS text FROM transcripts WHERE status between 200 and 299) t ON t.video_id = nullif(regexp_extract(v.url, '{routing.VIDEO_ID}', 1), '')""",
)
STORED = "SELECT digest, url, visit_date, visit_kind, text, video_title, duration FROM ingested WHERE error is null"
MALFORMED = """SELECT DISTINCT md5(concat_ws(chr(9), date, case when page_id % 7 = 3 then url else quality end, case when page_id % 7 = 3 then null else url end)) AS digest,
  case when page_id % 7 = 3 then null else url end AS url, 'Expected 3 fields' AS error FROM visits WHERE page_id % 7 = 3 or page_id % 9 = 4"""
REFUSED = f"SELECT digest, url, error FROM ingested WHERE error is not null UNION ALL {MALFORMED}"


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RESPONSES, **{n: load(spark, sf_dir, n) for n in NAMES}).drop("page_id")


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.transcript_text(load(spark, sf_dir, "transcripts")).select("video_id", "status", "transcript")


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = vs.read_visits(spark, visit_folder(spark, sf_dir))
    return ingest.ingest_pages(visits, responses(spark, sf_dir), transcripts(spark, sf_dir))


def stored_columns(good: DataFrame) -> DataFrame:
    video = F.when(F.col("visit_kind") == "youtube", F.col("title")).alias("video_title")
    return good.select("digest", "url", "visit_date", "visit_kind", "text", video, "duration")


@query("ingest_pages", "D27", STORED)
def q_ingest_pages(spark, sf_dir):
    return stored_columns(routing.split_results(ingested(spark, sf_dir))[0])


@query("ingest_quarantine", "C8", REFUSED)
def q_ingest_quarantine(spark, sf_dir):
    return routing.split_results(ingested(spark, sf_dir))[1].select("digest", "url", "error")


STREAMED = f"SELECT digest, url, text, null AS error FROM ingested WHERE error is null UNION ALL SELECT digest, url, null, error FROM ({REFUSED})"


@query("stream_extract", "I4", STREAMED)
def q_stream_extract(spark, sf_dir):
    store, bad = work_path(spark, "store"), work_path(spark, "quarantine")
    visits = st.stream_visits(spark, visit_folder(spark, sf_dir))
    archive = ar.index_responses(spark, responses(spark, sf_dir), work_path(spark, "responses"))
    st.stream_extract(spark, visits, archive, transcripts(spark, sf_dir), store, bad, work_path(spark, "stream-cp"))
    schema = spark.createDataFrame([], ingest.RECORD).schema
    good = ar.read_store(spark, store, schema, "visit_date").selectExpr("digest", "url", "text", "cast(null as string) AS error")
    return good.unionByName(spark.read.parquet(bad).selectExpr("digest", "url", "cast(null as string) AS text", "error"))
