"""URL column functions. One RFC 3986 pattern per part; no row-wise Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.domains import domain_of_host

# Tracking parameter names.
TRACKING_PARAM = r"^utm_(source|medium|campaign|term|content)="
VIDEO_TIME_PARAM = r"^t=[0-9]"

# Site kind and the host substrings that mark it, in rule order.
KIND_RULES = (
    ("youtube", ("youtube.com",)),
    ("arxiv", ("arxiv.com", "arxiv.org")),
    ("github.io", ("github.io",)),
    ("dataskeptic", ("dataskeptic.com",)),
)

SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
HOST = r"^(?:.*@)?(\[[^\]]*\]|[^:]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"
VALID_URL = r"(?i)^https?://[^/?#\s.]+(\.[^/?#\s.]+)*\.[a-z]{2,}(:[0-9]+)?([/?#]\S*)?$"
ASSET_FILE = r"(?i)\.(css|js|json|ico|svg|woff2?|ttf|mp3|mp4|avi|mov|zip|gz|exe|pdf)$"
# Image file extensions.
IMAGE_EXTENSIONS = "avif bmp gif heic heif jpg jpeg png webp".split()
IMAGE_FILE = r"\S\.(" + "|".join(IMAGE_EXTENSIONS) + r")\b"
# Hosts of which a label names a platform with many sites; links to them never count as foreign.
PLATFORMS = "blogspot ghost medium substack tumblr wixsite wordpress".split()
BLOG_PLATFORM = r"(?i)(^|\.)(" + "|".join(PLATFORMS) + r")\."
FEED_PROXY = r"feedburner|feedproxy"


def scheme(c: Column) -> Column:
    found = F.lower(F.regexp_extract(c, SCHEME, 1))
    return F.when(found == "", F.lit("http")).otherwise(found)


def netloc(c: Column) -> Column:
    return F.regexp_extract(c, NETLOC, 1)


def hostname(c: Column) -> Column:
    return F.lower(F.regexp_extract(netloc(c), HOST, 1))


def path(c: Column) -> Column:
    return F.regexp_extract(c, PATH, 1)


def query_string(c: Column) -> Column:
    return F.regexp_extract(c, QUERY, 1)


def url_parts(c: Column) -> dict[str, Column]:
    """Columns scheme, netloc, hostname, path, query of a URL."""
    return {
        "scheme": scheme(c),
        "netloc": netloc(c),
        "hostname": hostname(c),
        "path": path(c),
        "query": query_string(c),
    }


def _drop_params(query: Column, pattern: str) -> Column:
    kept = F.filter(F.split(query, "&"), lambda p: ~p.rlike(pattern))
    return F.array_join(kept, "&")


def strip_tracking(query: Column) -> Column:
    """Query string without tracking parameters."""
    return _drop_params(query, TRACKING_PARAM)


def strip_video_timestamp(query: Column, kind: Column) -> Column:
    """Query string without ``t=`` on video pages."""
    return F.when(kind == "youtube", _drop_params(query, VIDEO_TIME_PARAM)).otherwise(query)


def url_kind(host: Column) -> Column:
    """Site kind by host substring; the first rule wins."""
    out = F.lit("other")
    for kind, needles in reversed(KIND_RULES):
        hit = F.lit(False)
        for needle in needles:
            hit = hit | F.contains(host, F.lit(needle))
        out = F.when(hit, F.lit(kind)).otherwise(out)
    return out


def url_digest(c: Column) -> Column:
    return F.md5(c)


def base_url(c: Column) -> Column:
    return F.concat(scheme(c), F.lit("://"), F.lower(netloc(c)))


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` seen on page ``base``."""
    link = F.trim(link)
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    folder = F.regexp_replace(F.concat(root, path(base)), r"(//[^/]+.*/)[^/]*$|(//[^/]+)$", "$1$2")
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    plain = F.regexp_replace(link, r"^(\./)+", "")
    return (
        F.when(link == "", base)
        .when(link.rlike(SCHEME), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme(base), F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .when(F.startswith(link, F.lit("?")), F.concat(root, path(base), link))
        .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), link))
        .otherwise(F.concat(folder, plain))
    )


def clean_url(c: Column) -> Column:
    """Trimmed URL: lower-case host, no fragment, no tracking, no trailing slash."""
    c = F.trim(c)
    query = strip_tracking(query_string(c))
    slim = F.regexp_replace(path(c), "/+$", "")
    return F.concat(base_url(c), slim, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def is_valid_url(c: Column) -> Column:
    """Web scheme and a dotted host."""
    return c.rlike(VALID_URL)


def is_page_url(c: Column) -> Column:
    """Valid URL that does not name an asset or image file."""
    return is_valid_url(c) & ~path(c).rlike(ASSET_FILE) & ~is_image(path(c))


def host_info(c: Column) -> dict[str, Column]:
    return {"domain": domain_of_host(hostname(c)), "base_url": base_url(c)}


def url_language(c: Column) -> Column:
    """Language in the first path segment, or in ``hl=`` / ``lang=``; null if none."""
    segment = F.regexp_extract(path(c), r"^/([A-Za-z]{2})(?:/|$)", 1)
    param = F.regexp_extract(query_string(c), r"(?:^|&)(?:hl|lang)=([A-Za-z]{2})(?:[-_&]|$)", 1)
    return F.lower(F.coalesce(F.nullif(segment, F.lit("")), F.nullif(param, F.lit(""))))


def url_lang_ok(c: Column, lang: str | None) -> Column:
    """True if the URL names no language or the wanted one."""
    if lang is None:
        return F.lit(True)
    return F.coalesce(url_language(c) == lang, F.lit(True))


def is_image(c: Column) -> Column:
    return c.rlike(IMAGE_FILE)


def filter_urls(df: DataFrame, pattern: str | None, key: str = "list_id", url: str = "url") -> DataFrame:
    """Unique links of each list that hold ``pattern``; feed-proxy links if none does.

    The pattern test is reduced to one flag per list before it meets the links
    again, so a long list is never held by one task.
    """
    links = df.select(key, url).distinct()
    if pattern is None:
        return links
    hit = F.contains(F.col(url), F.lit(pattern))
    flagged = links.where(hit | F.col(url).rlike(FEED_PROXY)).withColumn("_hit", hit)
    lists = flagged.groupBy(key).agg(F.max("_hit").alias("_any"))
    return (
        flagged.join(lists, key)
        .where(F.col("_hit") | ~F.col("_any"))
        .select(key, url)
    )


def same_domain(link: Column, domain: Column, platforms: str = BLOG_PLATFORM) -> Column:
    """Link stays on ``domain``, or goes to a host that fits ``platforms``."""
    host = hostname(link)
    return (domain_of_host(host) == domain) | host.rlike(platforms)


def with_clean_link(df: DataFrame, base: str, link: str, out: str) -> DataFrame:
    """Add ``out``: ``link`` resolved against the site of ``base`` and cleaned.

    Each step is its own column, so no part of the chain is repeated in the plan. The last
    one comes out of `inline`, which keeps later filters from being pushed below it: there
    they would repeat the whole chain once per use.
    """
    staged = (
        df.withColumn("_base", base_url(F.col(base)))
        .withColumn("_full", resolve_url(F.col("_base"), F.col(link)))
        .withColumn("_query", strip_tracking(query_string(F.trim("_full"))))
        .withColumn(
            out,
            F.concat(
                base_url(F.trim("_full")),
                F.regexp_replace(path(F.trim("_full")), "/+$", ""),
                F.when(F.col("_query") == "", F.lit("")).otherwise(F.concat(F.lit("?"), "_query")),
            ),
        )
    )
    return staged.select(*df.columns, F.inline(F.array(F.struct(F.col(out)))))
