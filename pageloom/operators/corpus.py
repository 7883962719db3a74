"""Term tables, top terms, cards and samples over processed documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions import urls
from pageloom.functions.stem import with_stem
from pageloom.functions.stopwords import stop_words
from pageloom.functions.text import rx, sql_list
from pageloom.operators.blocks import drop_written, shuffles_dropped, written
from pageloom.session import ensure_checkpoint_dir

WORD = r"[\p{L}\p{N}_]{2,}"
# Document frequency bounds.
MIN_DOCS, MAX_SHARE = 2, 0.8
#: Rows of terms whose shuffles are on the disks at a time, and the most passes, each of which reads all rows.
PASS_ROWS, MOST_PASSES = 20_000_000, 16


def sql_words(c: str = "text", lang: str = "en") -> str:
    """Lower-case words of two characters and more without stop words, in text order."""
    return f"filter(regexp_extract_all(lower({c}), {rx(WORD)}, 0), w -> w not in {sql_list(stop_words(lang))})"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, computed once per row.

    A column would do the same until a filter is pushed below it and repeats its
    expression inside the lambdas, once per word.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def with_terms(docs: DataFrame, ngrams: int = 1) -> DataFrame:
    """Add ``terms``: array of (term, tf) per document.

    The counts come from run lengths in the sorted word array of the row, so no word is
    shuffled to count it. ``sort_array`` compares natively, ``array_sort`` would evaluate its comparing lambda.
    """
    grams = "w"
    if ngrams == 2:
        pairs = "transform(sequence(0, size(w) - 2), i -> concat(w[i], ' ', w[i + 1]))"
        grams = f"case when size(w) > 1 then concat(w, {pairs}) else w end"
    run = "named_struct('term', s[a], 'tf', case when j + 1 < size(at) then at[j + 1] else size(s) end - a)"
    starts = "filter(sequence(0, greatest(size(s) - 1, 0)), i -> i < size(s) and (i = 0 or s[i] <> s[i - 1]))"
    counted = _let(starts, "at", f"transform(at, (a, j) -> {run})")
    terms = _let(sql_words(), "w", _let(f"sort_array({grams})", "s", counted))
    return docs.selectExpr("*", f"{terms} AS terms")


def _bounded(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """Terms within the document frequency bounds; the document count is a scalar subquery."""
    return docs.sparkSession.sql(
        f"SELECT * FROM {{counts}} WHERE df >= {MIN_DOCS} AND df <= {MAX_SHARE}D * (SELECT count(*) FROM {{docs}})",
        counts=counts,
        docs=docs,
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, df, n) within the document frequency bounds.

    Each document gives its words once as they are and once distinct, so one aggregate by
    term yields both counts. Only terms combined on the map side are shuffled, and the work
    per word stays in generated code.
    """
    words = docs.selectExpr(f"regexp_extract_all(lower(text), {rx(WORD)}, 0) AS _w")
    twice = words.selectExpr(
        "explode(array(named_struct('d', 0L, 'ws', _w), named_struct('d', 1L, 'ws', array_distinct(_w)))) AS x"
    )
    rows = twice.selectExpr("x.d AS d", "explode(x.ws) AS term").where(f"term not in {sql_list(stop_words('en'))}")
    counts = rows.groupBy("term").agg(F.sum("d").alias("df"), F.sum(1 - F.col("d")).alias("n"))
    return _bounded(counts, docs.select("text"))


def term_rows(docs: DataFrame, key: str = "doc_id", ngrams: int = 1, stem: bool = False) -> DataFrame:
    """(key, term, tf): the terms of each document, or the stems of its words.

    Stems are made once per different word and joined to the rows; words of one stem add up in their document. The rows
    are written once for both.
    """
    rows = with_terms(docs.select(key, "text"), ngrams).selectExpr(key, "inline(terms)")
    if not stem:
        return rows
    rows = written(rows, "stem-rows")
    stems = with_stem(rows.select("term").distinct(), "term")
    return rows.join(stems, "term").groupBy(key, F.col("stem").alias("term")).agg(F.sum("tf").cast("int").alias("tf"))


def stem_counts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(term, df, n) of the stems within the document frequency bounds; ``key`` must tell the documents apart."""
    counts = term_rows(docs, key, stem=True).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum(F.col("tf").cast("bigint")).alias("n"))
    return _bounded(counts, docs.select("text"))


def passes(rows: DataFrame, *by: str) -> list[Column]:
    """Conditions that deal the rows to passes by a digest of the columns; each row meets one, equal values the same."""
    n = min(MOST_PASSES, max(1, -(-rows.count() // PASS_ROWS)))
    return [F.pmod(F.xxhash64(*by, F.lit(7)), F.lit(n)) == p for p in range(n)]


def tfidf_parts(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame, list[Column]]:
    """The rows (key, term, tf) of words and word pairs, their dictionary (term, idf), both written, and the passes over terms.

    The dictionary is made in passes over parts of the terms, so the shuffles of one part are on the disks at a time.
    """
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        rows = written(term_rows(docs, key, ngrams=2), "terms")
        dealt, n, parts = passes(rows, "term"), docs.count(), []
        for part in dealt:
            counts = rows.where(part).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            kept = counts.where(f"df >= {MIN_DOCS} AND df <= {MAX_SHARE}D * {n}L").selectExpr("term", f"ln((1 + {n}L) / (1 + df)) + 1 AS idf")
            parts.append(written(kept, "dictionary"))
    return rows, together(parts), dealt


def together(parts: list[DataFrame]) -> DataFrame:
    """The rows of all parts."""
    return reduce(DataFrame.unionAll, parts)


def tfidf(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, term, weight): smoothed idf, L2 norm per document, over words and word pairs.

    The rows of terms are made and written once, packed; the dictionary with document frequencies and the weights both
    come from there, in passes over parts of the terms, and the norms in passes over parts of the documents. A pass leaves
    its rows and no shuffle files. Both sides of a join are read from files, so Spark can split the rows of a frequent term.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    normed = lambda rows: rows.select(key, "term", (F.col("_w") / norm).alias("weight"))
    rows, kept, dealt = tfidf_parts(docs, key)
    with shuffles_dropped(docs.sparkSession):
        joined = [rows.where(part).join(kept.where(part), "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("_w")) for part in dealt]
        weighted = [written(part, "weights") for part in joined]
        drop_written(rows)
        drop_written(kept)
        if len(dealt) == 1:
            return normed(weighted[0])
        whole = together(weighted)
        out = together([written(normed(whole.where(part)), "tfidf") for part in passes(whole, key)])
        drop_written(whole)
    return out


def top_terms(df: DataFrame, n: int, group: str = "topic", weight: str = "weight") -> DataFrame:
    """(group, rank, term, weight) of the n heaviest terms of each group.

    Spark keeps the n best per task before the shuffle, so a large group stays cheap.
    """
    w = Window.partitionBy(group).orderBy(F.col(weight).desc(), "term")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select(group, "rank", "term", weight)


def partition_by_kind(df: DataFrame, path: str, kind: str = "visit_kind") -> DataFrame:
    """Write one folder per kind and return the number of documents in each.

    The groups stay distributed: members are files, not one list per kind.
    """
    df.write.partitionBy(kind).parquet(path)
    return df.sparkSession.read.parquet(path).groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


def cards(df: DataFrame) -> DataFrame:
    """Card columns; the author falls back to the domain, then to the URL."""
    host = F.nullif(urls.hostname(F.col("url")), F.lit(""))
    return df.select(
        "url", "visit_date", "visit_kind", "title", "duration", "date", "image",
        host.alias("domain"),
        F.coalesce(F.nullif("author", F.lit("")), host, F.col("url")).alias("author"),
    )


def sample_per_kind(df: DataFrame, sizes: dict[str, int], kind: str, key: str, seed: int = 42) -> DataFrame:
    """``sizes[kind]`` draws with replacement per kind: (kind, draw, key).

    Members of a kind are ranked by the md5 of their key. A rank is found through counts
    per three-digit md5 prefix (4096 at most per kind), and only the prefixes that a draw
    fell into are ranked, so no task ever orders a whole kind.
    """
    spark = df.sparkSession
    members = df.where(F.col(kind).isin(*sizes)).select(kind, key, F.md5(F.col(key).cast("string")).alias("_h"))
    members = members.withColumn("_p", F.substring("_h", 1, 3))
    counts = members.groupBy(kind, "_p").agg(F.count(F.lit(1)).alias("_n"))
    by_kind = Window.partitionBy(kind).orderBy("_p")
    spans = counts.select(
        kind,
        "_p",
        (F.sum("_n").over(by_kind) - F.col("_n")).alias("_from"),
        F.sum("_n").over(by_kind).alias("_to"),
        F.sum("_n").over(Window.partitionBy(kind)).alias("_all"),
    )
    # One row per draw: bounded by the requested sizes.
    wanted = spark.createDataFrame([(k, n) for k, n in sizes.items()], f"{kind} string, _k int").select(
        kind, F.explode(F.sequence(F.lit(1), F.col("_k"))).alias("draw")
    )
    number = F.conv(F.substring(F.md5(F.concat_ws("-", kind, "draw", F.lit(seed))), 1, 8), 16, 10).cast("bigint")
    index = F.pmod(number, F.col("_all"))
    draws = (
        wanted.join(spans, kind)
        .withColumn("_i", index)
        .where((F.col("_i") >= F.col("_from")) & (F.col("_i") < F.col("_to")))
        .select(kind, "draw", "_p", (F.col("_i") - F.col("_from") + 1).alias("_rank"))
    )
    hit = members.join(F.broadcast(draws.select(kind, "_p").distinct()), [kind, "_p"], "left_semi")
    ranked = hit.withColumn("_rank", F.row_number().over(Window.partitionBy(kind, "_p").orderBy("_h", key)))
    return draws.join(ranked, [kind, "_p", "_rank"]).select(kind, "draw", key)
