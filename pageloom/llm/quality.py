"""Quality rules in SQL functions: counts per text, then a hashed n-gram log-likelihood ratio.

Words and pairs of words fall into hashed buckets. Two multinomials over the buckets are counted with Spark, one over
all documents and one over trusted ones; a text's score is the mean log ratio of its n-grams, so long and short texts
compare. Every text is judged against one fixed threshold; nothing is drawn at random.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the multinomials.
BUCKETS = 16_384
#: Count added to every bucket.
SMOOTHING = 1.0
#: Mean log ratio below which a text is dropped.
THRESHOLD = -0.06
#: Neutral n-grams added to every text, so that a few n-grams alone do not decide.
PRIOR = 20
#: Words in the windows that are searched for repeats.
REPEAT = 5

BLANKS = " \t\n\x0b\f\r"


def bound(frame: DataFrame, kept: list[str], **new: Column) -> DataFrame:
    """``kept`` and new columns, evaluated once per row; as plain columns they would be repeated inside lambdas."""
    return frame.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in new.items()]))))


def with_words(docs: DataFrame, kept: list[str], text: Column) -> DataFrame:
    """Adds ``_words`` and ``_hashes``, one per word ``[^\\x20\\x09-\\x0D]+`` of the text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    cut = bound(docs, kept, _words=F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1)))
    return bound(cut, [*kept, "_words"], _hashes=F.transform("_words", lambda w: F.xxhash64(w)))


def _buckets() -> Column:
    """Buckets of all words and pairs of neighbouring words."""
    n = F.size("_hashes")
    words = F.transform("_hashes", lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    pair = lambda h, i: F.pmod(F.xxhash64(h, F.get("_hashes", i + 1)), F.lit(BUCKETS)).cast("int")
    pairs = F.transform(F.slice("_hashes", F.lit(1), F.greatest(n - 1, F.lit(0))), pair)
    return F.concat(words, pairs)


@dataclass(frozen=True)
class Ratios:
    """Log ratio of target to raw probability for every bucket."""

    values: tuple[float, ...]

    def column(self) -> Column:
        # one literal that the optimizer folds into an array
        return F.split(F.lit(",".join(f"{v:.6f}" for v in self.values)), ",").cast("array<double>")


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Ratios:
    """Count both multinomials over all ``docs``; ``trusted`` has the ids of the target texts.

    One aggregate over buckets, combined before the shuffle; only its rows, one per bucket, come to the driver. Ids in
    ``trusted`` may repeat; null ids are trusted by nobody. Without trusted texts, or without documents, all ratios
    are 0.
    """
    ids = trusted.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().withColumn("_trusted", F.lit(True))
    # trusted ids grow with the corpus: both sides are sorted at every size, never broadcast
    marked = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text")).join(ids.hint("merge"), F.col("_key") == F.col("_id"), "left")
    worded = with_words(marked.select("_text", F.coalesce("_trusted", F.lit(False)).alias("_trusted")), ["_trusted"], F.col("_text"))
    counted = worded.select("_trusted", F.explode(_buckets()).alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("raw"), F.count_if("_trusted").alias("target")
    )
    raw, target = [SMOOTHING] * BUCKETS, [SMOOTHING] * BUCKETS
    for bucket, n_raw, n_target in counted.collect():
        raw[bucket] += n_raw
        target[bucket] += n_target
    if sum(target) == SMOOTHING * BUCKETS:
        return Ratios((0.0,) * BUCKETS)
    all_raw, all_target = sum(raw), sum(target)
    return Ratios(tuple(math.log(t / all_target) - math.log(r / all_raw) for t, r in zip(target, raw)))


def _length_sum(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + F.length(w))


def assess(
    docs: DataFrame, ratios: Ratios, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``score``, ``kept``.

    ``score`` is the sum of the log ratios of all words and word pairs, over their number plus ``PRIOR``. A text is
    kept if the base rules pass and the score reaches the threshold. Null, empty and blank texts have no words, so
    all counts and the score are 0 and the base rules fail. Repeated rows give repeated results; empty tables none;
    other columns are not read. Nothing is shuffled.
    """
    kept = ["_id", "_text"]
    base = with_words(docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")), kept, F.col("_text"))
    n = F.size("_hashes")
    window = lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + j) for j in range(1, REPEAT)])
    windows = F.transform(F.slice("_hashes", F.lit(1), F.greatest(n - REPEAT + 1, F.lit(0))), window)
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    known = bound(base, [*kept, "_words", "_hashes"], _windows=windows, _lines=lines, _ratios=ratios.column())
    scored = bound(
        known,
        ["_id", "_windows"],
        n_words=n.cast("long"),
        word_chars=_length_sum(F.col("_words")),
        n_symbols=F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        _sum=F.aggregate(_buckets(), F.lit(0.0), lambda total, b: total + F.get("_ratios", b)),
        _plain=F.size(F.array_distinct("_windows")) == F.size("_windows"),
    )
    names = ["_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "_sum"]
    # windows found twice, by position: equal neighbours after sorting; texts without any are not sorted
    none = F.array().cast("array<struct<g:bigint,i:int>>")
    numbered = F.transform("_windows", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    ordered = bound(scored, names, _sorted=F.when(F.col("_plain"), none).otherwise(F.sort_array(numbered)))
    twice = lambda x, i: (F.get("_sorted", i - 1)["g"] == x["g"]) | (F.get("_sorted", i + 1)["g"] == x["g"])
    places = F.sort_array(F.transform(F.filter("_sorted", lambda x, i: F.coalesce(twice(x, i), F.lit(False))), lambda x: x["i"]))
    placed = bound(ordered, names, _places=places)
    reach = F.transform("_places", lambda p, i: F.least(F.lit(REPEAT), F.coalesce(F.get("_places", i + 1) - p, F.lit(REPEAT))))
    covered = F.aggregate(reach, F.lit(0).cast("long"), lambda total, k: total + k)
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        placed.withColumn("n_repeat_words", covered)
        .withColumn("base_failed", failed)
        .withColumn("score", F.col("_sum") / (n_grams + PRIOR))
        .select(
            F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score",
            (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"),
        )
    )
