"""Queries over documents, run logs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions.stem import DUCKDB, with_stem
from pageloom.functions.stopwords import stop_words
from pageloom.operators import corpus, runlog, topics
from pageloom.plans import markup_sql as d
from pageloom.plans.flow_queries import log_lines
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load
from pageloom.plans.url_queries import d_host
from pageloom.session import work_path
from pageloom.streaming import visits as st

STOPS = d.tags(stop_words("en"))
cte("doc_words", f"SELECT doc_id, lang, list_filter(regexp_extract_all(lower(text), '{corpus.WORD}', 0), lambda w: w not in {STOPS}) AS words FROM documents")
cte("doc_terms", "SELECT doc_id, lang, term, count(*) AS tf FROM (SELECT doc_id, lang, unnest(words) AS term FROM doc_words) GROUP BY ALL")


def docs(spark, sf_dir):
    return load(spark, sf_dir, "documents")


@query(
    "term_counts",
    "H1",
    "SELECT term, count(*) AS df, cast(sum(tf) as bigint) AS n FROM doc_terms GROUP BY term HAVING count(*) >= 2 and count(*) <= 0.8 * (SELECT count(*) FROM documents)",
)
def q_term_counts(spark, sf_dir):
    return corpus.term_counts(docs(spark, sf_dir))


cte(
    "doc_grams",
    """SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM doc_words
UNION ALL SELECT doc_id, words[i] || ' ' || words[i + 1] FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM doc_words)) GROUP BY ALL""",
)
cte(
    "gram_idf",
    """SELECT term, ln((1 + n) / (1 + df)::double) + 1 AS idf FROM (SELECT term, count(*) AS df, (SELECT count(*) FROM documents) AS n FROM doc_grams GROUP BY term)
WHERE df >= 2 and df <= 0.8 * n""",
)


@query(
    "tfidf",
    "H2",
    "SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM (SELECT g.doc_id, g.term, g.tf * i.idf AS w FROM doc_grams g JOIN gram_idf i ON i.term = g.term)",
)
def q_tfidf(spark, sf_dir):
    return corpus.tfidf(docs(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query("lda_topics", "H3")
def q_lda_topics(spark, sf_dir):
    return topics.lda_topics(docs(spark, sf_dir))


@query("nmf_topics", "H4")
def q_nmf_topics(spark, sf_dir):
    return topics.nmf_topics(docs(spark, sf_dir))


@query("nmf_documents", "H4")
def q_nmf_documents(spark, sf_dir):
    return topics.nmf_documents(docs(spark, sf_dir), iterations=4)


def d_stem(word: str) -> str:
    """The steps of the stemmer as nested subqueries, in the other engine's functions."""
    source = f"(SELECT *, {word} AS w FROM (SELECT DISTINCT term FROM doc_terms))"
    for found, new in DUCKDB.steps():
        source = f"(SELECT term, w, case when length(term) > 2 then {found} else '' end AS s FROM {source})"
        source = f"(SELECT term, {new} AS w FROM (SELECT *, left(w, length(w) - length(s)) AS b FROM {source}))"
    return source


cte("doc_stems", f"SELECT term, w AS stem FROM {d_stem('term')}")


@query("stems", "H10", "SELECT term, stem FROM doc_stems")
def q_stems(spark, sf_dir):
    words = corpus.term_rows(docs(spark, sf_dir)).select("term").distinct()
    return with_stem(words, "term")


@query(
    "stem_counts",
    "H10",
    "SELECT stem AS term, count(*) AS df, cast(sum(tf) as bigint) AS n FROM (SELECT doc_id, stem, sum(tf) AS tf FROM doc_terms JOIN doc_stems USING (term) GROUP BY ALL) "
    "GROUP BY stem HAVING count(*) >= 2 and count(*) <= 0.8 * (SELECT count(*) FROM documents)",
)
def q_stem_counts(spark, sf_dir):
    return corpus.stem_counts(docs(spark, sf_dir))


@query("embedding_topics", "H5")
def q_embedding_topics(spark, sf_dir):
    return topics.embedding_topics(load(spark, sf_dir, "embeddings"), docs(spark, sf_dir))


@query(
    "top_terms",
    "H6",
    "SELECT lang, cast(rank as int) AS rank, term, n FROM (SELECT lang, term, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank FROM "
    "(SELECT lang, term, cast(sum(tf) as bigint) AS n FROM doc_terms GROUP BY ALL)) WHERE rank <= 10",
)
def q_top_terms(spark, sf_dir):
    rows = corpus.with_terms(docs(spark, sf_dir).select("lang", "text")).selectExpr("lang", "inline(terms)")
    counts = rows.groupBy("lang", "term").agg(F.sum(F.col("tf").cast("bigint")).alias("n"))
    return corpus.top_terms(counts, 10, "lang", "n")


@query("partition_by_kind", "H7", "SELECT quality AS visit_kind, count(*) AS n FROM visits GROUP BY ALL")
def q_partition_by_kind(spark, sf_dir):
    v = load(spark, sf_dir, "visits").withColumnRenamed("quality", "visit_kind")
    return corpus.partition_by_kind(v, work_path(spark, "kinds"))


@query(
    "sample_per_kind",
    "H8",
    """SELECT d.quality, d.draw, m.page_id FROM (
  SELECT quality, draw, cast('0x' || substr(md5(quality || '-' || draw || '-42'), 1, 8) as bigint) % n + 1 AS rank FROM (
    SELECT quality, n, unnest(range(1, case quality when 'Queue' then 51 else 21 end)) AS draw FROM (SELECT quality, count(*) AS n FROM visits WHERE quality in ('Queue', 'Tool') GROUP BY ALL))) d
JOIN (SELECT quality, page_id, row_number() OVER (PARTITION BY quality ORDER BY md5(cast(page_id as varchar)), page_id) AS rank FROM visits) m ON m.quality = d.quality and m.rank = d.rank""",
)
def q_sample_per_kind(spark, sf_dir):
    v = load(spark, sf_dir, "visits")
    out = corpus.sample_per_kind(v, {"Queue": 50, "Tool": 20}, "quality", "page_id")
    return out.withColumn("draw", F.col("draw").cast("bigint"))


@query(
    "cards",
    "H9",
    f"SELECT url, date AS visit_date, quality AS visit_kind, 't' AS title, 60 AS duration, date, null::varchar AS image, nullif({d_host('url')}, '') AS domain, "
    f"coalesce(nullif(case when page_id % 2 = 0 then 'Ann' else '' end, ''), nullif({d_host('url')}, ''), url) AS author FROM visits",
)
def q_cards(spark, sf_dir):
    v = load(spark, sf_dir, "visits").selectExpr(
        "url", "date AS visit_date", "quality AS visit_kind", "'t' AS title", "60 AS duration", "date", "cast(null as string) AS image",
        "case when page_id % 2 = 0 then 'Ann' else '' end AS author",
    )
    return corpus.cards(v)


@query("lda_topics_wide", "H10")
def q_lda_topics_wide(spark, sf_dir):
    """Ten topics over stems, twenty rounds."""
    return topics.lda_topics(docs(spark, sf_dir), k=10, max_iter=20, stem=True)


cte(
    "log_rows",
    """SELECT 'INIT' AS step, start, start AS finish, null::double AS duration, operation, digest, kind, null::varchar AS error FROM step_outcomes
UNION ALL SELECT step, start, round(start + duration, 2), duration, operation, digest, kind, case when step in ('WARN', 'FAIL') then 'Error in ' || operation end FROM step_outcomes""",
)


def log(spark, sf_dir):
    return runlog.parse_log(runlog.step_log(load(spark, sf_dir, "step_outcomes")))


@query("step_log", "I5", "SELECT step, round(start, 2) AS start, round(finish, 2) AS finish, round(duration, 2) AS duration, operation, digest, kind, error FROM log_rows")
def q_step_log(spark, sf_dir):
    return log(spark, sf_dir).withColumns({c: F.round(c, 2) for c in ("start", "finish", "duration")})


@query(
    "step_stats",
    "I6",
    "SELECT operation, kind, count(*) AS n, round(count_if(step = 'FAIL') / count(*)::double, 6) AS fail_rate, round(avg(duration), 6) AS mean, round(quantile_cont(duration, 0.5), 6) AS p50, "
    "round(quantile_cont(duration, 0.95), 6) AS p95 FROM step_outcomes GROUP BY operation, kind",
)
def q_step_stats(spark, sf_dir):
    return runlog.step_stats(log(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("fail_rate", "mean", "p50", "p95")})


@query("step_spans", "I7", "SELECT digest, operation, start, round(start + duration, 2) AS finish, step AS outcome FROM step_outcomes")
def q_step_spans(spark, sf_dir):
    return runlog.step_spans(log(spark, sf_dir)).withColumn("finish", F.round("finish", 2))


@query(
    "step_severity",
    "I8",
    "SELECT digest, step, case step when 'FAIL' then 'error' when 'WARN' then 'warn' else 'info' end AS level, cast(step = 'FAIL' as int) AS quarantined FROM log_rows",
)
def q_step_severity(spark, sf_dir):
    out = runlog.apply_severity(log(spark, sf_dir), ["op0", "op1", "op2", "op3"])
    return out.select("digest", "step", "level", F.col("quarantined").cast("int").alias("quarantined"))


def visit_folder(spark, sf_dir, repeats: int = 1) -> str:
    """The visit log as several files, each with a header line."""
    path = work_path(spark, "visit-stream")
    lines = log_lines(spark, sf_dir).withColumnRenamed("value", "date\tquality\turl").repartition(4)
    for _ in range(repeats):
        lines.write.mode("append").options(header="true", sep="\x01", quote="", ignoreTrailingWhiteSpace="false").csv(path)
    return path


STREAM_SQL = """SELECT date, quality, url, 1 AS good FROM visits WHERE not (page_id % 7 = 3 or page_id % 9 = 4)
UNION ALL SELECT date, case when page_id % 7 = 3 then url else quality end, case when page_id % 7 = 3 then null else url end, 0 FROM visits WHERE page_id % 7 = 3 or page_id % 9 = 4"""


@query("stream_visits", "I1", STREAM_SQL)
def q_stream_visits(spark, sf_dir):
    out = work_path(spark, "stream-out")
    st.append_available(st.stream_visits(spark, visit_folder(spark, sf_dir)), out, work_path(spark, "stream-cp"))
    return spark.read.parquet(out).select("date", "quality", "url", F.col("error").isNull().cast("int").alias("good"))


@query("stream_batches", "I2", STREAM_SQL)
def q_stream_batches(spark, sf_dir):
    out = work_path(spark, "stream-out")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    visits = st.stream_visits(spark, visit_folder(spark, sf_dir), files_per_batch=2)
    st.run_available(visits, keep, work_path(spark, "stream-cp"))
    return spark.read.parquet(out).select("date", "quality", "url", F.col("error").isNull().cast("int").alias("good"))


@query("stream_unseen", "I3", "SELECT DISTINCT md5(url) AS digest, url FROM visits WHERE not (page_id % 7 = 3 or page_id % 9 = 4)")
def q_stream_unseen(spark, sf_dir):
    out = work_path(spark, "stream-out")
    visits = st.stream_visits(spark, visit_folder(spark, sf_dir, repeats=2), files_per_batch=3)
    st.append_available(st.stream_unseen(visits), out, work_path(spark, "stream-cp"))
    return spark.read.parquet(out).select("digest", "url")


@query("stream_seen", "I3", "SELECT DISTINCT md5(url) AS digest, url FROM visits WHERE not (page_id % 7 = 3 or page_id % 9 = 4)")
def q_stream_seen(spark, sf_dir):
    """The log twice, under two checkpoints: what the first run has seen is not handed on by the second."""
    out, seen = work_path(spark, "stream-out"), st.seen_set(spark, work_path(spark, "seen"))

    def keep(fresh, name):
        fresh.write.mode("overwrite").parquet(f"{out}/batch={name}")

    folder = visit_folder(spark, sf_dir, repeats=2)
    for _ in range(2):
        st.stream_seen(spark, st.stream_visits(spark, folder, files_per_batch=5), seen, keep, work_path(spark, "stream-cp"), runs=2)
    return spark.read.parquet(out).select("digest", "url")
