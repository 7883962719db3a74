"""URL verdicts: host and path rules first, else logistic regression on hashed character n-grams.

The model is fitted by Spark from a small labelled table and applied with SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of the hashed n-grams.
BUCKETS = 4096
#: Lengths of the character n-grams.
GRAMS = (3, 4, 5)

#: Rules of the contract, in its order: verdict and host with path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Labelled hosts and paths the model learns from: first those to block, then those to allow.
BLOCKED = (
    "spam-farm.example.com/en/1", "spam-links.example.net/buy", "www.spam-farm.example.net/de/17", "best-spam.example.org/fr/2",
    "cheap-pills.example.com/en/9", "www.cheap-pills.example.net/es/4", "pills-online.example.com/order", "cheap-meds.example.net/fr/8",
    "free-casino.example.com/en/3", "casino-bonus.example.net/win", "online-casino.example.org/de/5", "www.bet-casino.example.com/es/77",
    "win-money.example.net/en/5", "free-money-now.example.com/claim", "click-here-win.example.com/en/12", "lottery-winner.example.net/prize",
    "xxx-videos.example.com/en/6", "adult-cams.example.net/fr/1", "hot-singles.example.com/en/41", "xxx-free.example.org/es/3",
    "cheap-loans.example.com/apply", "fast-loan.example.net/en/2", "crypto-profit.example.com/invest", "replica-watches.example.net/shop",
    "casino-win.example.net/en/31", "bets-online.example.com/en/8", "free-bets.example.net/de/60", "adult-x.example.org/en/2",
    "m.online-casino.example.com/en/3.html", "m.cheap-meds.example.net/fr/81", "m.win-bets.example.net/en/40", "blog.casino-club.example.com/en/5",
    "ads-track.example.net/en/77", "ad-tracker.example.com/pixel", "track-clicks.example.com/en/4", "adult-video.example.com/es/9",
    "cheap-watches.example.com/en/14", "seo-links.example.net/buy-backlinks", "link-farm.example.com/en/20", "buy-followers.example.org/en/7",
)
ALLOWED = (
    "blog.garden.example.com/en/12", "www.museum.example.net/es/4", "news.harbor.example.net/en/201", "library.example.com/en/88",
    "m.weather.example.net/de/31", "docs.compiler.example.com/manual", "history.example.net/fr/9", "www.recipes.example.com/en/540",
    "blog.thinor.example.net/en/77", "www.ertion.example.com/es/3", "m.thening.example.net/fr/640", "blog.reation.example.com/en/18",
    "hiking.example.net/es/20", "astronomy.example.com/en/7", "university.example.net/de/2", "poems.example.com/es/66",
    "www.cityhall.example.net/es/14", "train-times.example.com/en/5", "open-maps.example.net/en/330", "blog.teacher.example.com/en/41",
    "science-news.example.net/en/15", "www.theater.example.com/en/8", "blog.handor.example.net/fr/97", "thstin.example.com/en/410",
    "m.erander.example.net/en/93", "www.thoran.example.com/es/51", "city-guide.example.com/en/61", "blog.stonhe.example.com/en/4",
    "north-sea.example.net/en/19", "www.tionan.example.net/de/87", "m.inganen.example.com/en/70", "bird-watch.example.com/es/8",
    "recipes-daily.example.net/es/12", "film-review.example.com/en/23", "m.oneres.example.net/en/6", "book-club.example.com/fr/11",
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_col: Column, path_col: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, or nulls: it fits its host and all subdomains from its path on."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, entry in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = entry.partition("/")
        fits = ((host_col == name) | host_col.endswith(f".{name}")) & path_col.startswith(f"/{rest}")
        text, verdict = F.when(fits, entry).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def with_parts(table: DataFrame, url_col: str, *kept: str, n_buckets: int = BUCKETS) -> DataFrame:
    """``kept`` columns, ``host``, ``path`` and ``_buckets``: the distinct buckets of all character n-grams.

    Host and path are marked at both ends, runs of digits count as one ``0``. ``inline`` binds each step once per row;
    as plain columns the steps would be repeated for every n-gram.
    """
    def bound(frame: DataFrame, names: list[str], **new) -> DataFrame:
        return frame.select(*names, F.inline(F.array(F.struct(*[c.alias(n) for n, c in new.items()]))))

    def plain(text) -> Column:
        return F.regexp_replace(F.lower(text), "[0-9]+", "0")

    def grams(text: Column, tag: str) -> list[Column]:
        return [
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))),
                lambda i, n=n: F.pmod(F.xxhash64(F.lit(tag), F.substring(text, i, F.lit(n))), F.lit(n_buckets)).cast("int"),
            )
            for n in GRAMS
        ]

    names = list(kept)
    found = bound(table, names, host=host(F.col(url_col)), path=path(F.col(url_col)))
    marked = bound(found, [*names, "host", "path"], _h=F.concat(F.lit("^"), plain("host"), F.lit("$")), _p=F.concat(plain("path"), F.lit("$")))
    hashed = F.array_distinct(F.concat(*grams(F.col("_h"), "h"), *grams(F.col("_p"), "p")))
    return bound(marked, [*names, "host", "path"], _buckets=hashed)


@dataclass(frozen=True)
class UrlModel:
    """Weights per bucket and intercept; a positive sum means block."""

    weights: tuple[float, ...]
    intercept: float

    def logit(self, hashed: Column) -> Column:
        weights = F.array(*[F.lit(w) for w in self.weights])
        return F.lit(self.intercept) + F.aggregate(hashed, F.lit(0.0), lambda total, b: total + F.element_at(weights, b + 1))


def labelled(spark: SparkSession) -> DataFrame:
    found = [(f"https://{u}", 1.0) for u in BLOCKED] + [(f"https://{u}", 0.0) for u in ALLOWED]
    return spark.createDataFrame(found, "url string, label double").coalesce(1)


def fit(table: DataFrame, n_buckets: int = BUCKETS, regularisation: float = 0.001) -> UrlModel:
    """Logistic regression over a labelled table ``(url, label)``; label 1 means block.

    Null urls count as empty; rows without a label are left out. Without both labels the intercept alone decides.
    """
    hashed = with_parts(table.where("label is not null"), "url", "label", n_buckets=n_buckets)
    dense = F.transform(F.sequence(F.lit(0), F.lit(n_buckets - 1)), lambda i: F.array_contains("_buckets", i).cast("double"))
    rows = hashed.select("label", array_to_vector(dense).alias("features"))
    model = LogisticRegression(maxIter=50, regParam=regularisation, elasticNetParam=0.0).fit(rows)
    return UrlModel(tuple(float(w) for w in model.coefficients.toArray()), float(model.intercept))


def judge(pages: DataFrame, model: UrlModel, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows ``(id, host, path, rule, verdict, logit)``, one per row of ``pages``.

    The longest fitting rule decides; without one the model does: block if its logit is positive. Null urls and urls
    without ``://`` have an empty host and path, fit no rule and are judged by the model as such. Repeated rows give
    repeated results, empty tables none; other columns are not read. Nothing is shuffled.
    """
    parts = with_parts(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url", "_id", n_buckets=len(model.weights))
    text, verdict = rule(F.col("host"), F.col("path"), rules)
    scored = parts.withColumn("rule", text).withColumn("_rule", verdict).withColumn("logit", model.logit(F.col("_buckets")))
    verdict = F.coalesce("_rule", F.when(F.col("logit") > 0, "block").otherwise("allow"))
    return scored.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "logit")
