"""The page cascade: rows -> own / scored / classified / baseline text -> one choice.

The rows of a page and all candidates are made in its own row (``plans.cascade``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import rx, sql_fingerprint, sql_reading_time, sql_trim_ws
from pageloom.operators import markup, prune
from pageloom.operators.inrow import bind, lets, struct
from pageloom.plans.cascade import Options, sql_page, with_page

ARTICLE_BODY = r"(?is)\x22articlebody\x22\s*:\s*\x22((?:[^\x22\\]|\\.)+)\x22"
LD_SCRIPT = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script\s*>"


def gather(flag: str, value: str, sep: str = "chr(10)") -> str:
    """Aggregate: ``value`` of the flagged rows in row order."""
    row = f"case when {flag} then named_struct('o', pos, 'v', {value}) end"
    return f"array_join(transform(array_sort(collect_list({row})), r -> r.v), {sep})"


def article_body(html: str) -> str:
    """Article text named in a JSON-LD script, null if none."""
    script = f"array_join(regexp_extract_all({html}, {rx(LD_SCRIPT)}, 1), ' ')"
    found = f"regexp_extract({script}, {rx(ARTICLE_BODY)}, 1)"
    return f"nullif({sql_trim_ws(f'replace({found}, chr(92) || chr(34), chr(34))')}, '')"


LENGTHS = ("own_len", "scored_len", "plain_len", "good_len", "own_p_len", "own_ps", "own_tables", "scored_noise")


def choice_steps(o: Options) -> list[tuple[str, str]]:
    """From the lengths to ``choice``: own, scored, classified or baseline."""
    scored_wins = f"""case when scored_len in (0, own_len) then false when own_len = 0 then true
      when own_len > 2 * scored_len then false when scored_len > 2 * own_len then true
      else scored_len > {2 * o.min_size} and (own_p_len = 0 or own_tables > own_ps) end"""
    if not o.fallback:
        scored_wins = "false"
    elif o.recall:
        scored_wins = f"case when own_len > {10 * o.min_size} then false else {scored_wins} end"
    rescue = f"(if(by_score, scored_len, own_len) < {o.min_size} or (by_score and scored_noise > 0)) and good_len > 0"
    if not o.fallback:
        rescue = "false"
    elif o.recall:
        rescue = f"own_len <= {10 * o.min_size} and {rescue}"
    return [
        ("by_score", scored_wins),
        ("pick", f"case when {rescue} then 'classified' when by_score then 'scored' else 'own' end"),
        ("taken", "case pick when 'classified' then good_len when 'scored' then plain_len else own_len end"),
        ("choice", f"if(taken < {o.min_size}, 'baseline', pick)"),
    ]


def choose_extraction(df: DataFrame, o: Options = Options()) -> DataFrame:
    """Add ``choice`` from the columns ``LENGTHS``."""
    return df.selectExpr("*", f"{lets(choice_steps(o), 'choice')} AS choice")


def picked_rows(pages: DataFrame, candidate: str, o: Options = Options()) -> DataFrame:
    """(page_id, pos, role, text): the rows of a candidate: ``own``, ``scored_known`` or ``good`` (without the role)."""
    steps, _ = sql_page("html", o)
    shown = {"pos": "r.pos", "text": "r.text"} if candidate == "good" else {"pos": "r.pos", "role": "r.role", "text": "get(rows, r.at).text"}
    shown = f"transform({candidate}, r -> {struct(**shown)})"
    return with_page(pages, steps, {"found": shown}, "page_id").selectExpr("page_id", "inline(found)")


def candidate_lengths(pages: DataFrame, o: Options = Options()) -> DataFrame:
    """(page_id, lengths): one row for each page that has rows."""
    steps, values = sql_page("html", o)
    fields = {n: values[n] for n in LENGTHS} | {"n_rows": "size(rows)"}
    return with_page(pages, steps, fields, "page_id").where("n_rows > 0").drop("n_rows")


def baseline_texts(pages: DataFrame) -> DataFrame:
    """(page_id, text, article_text, paragraph_text) of each page that has rows."""
    steps, values = sql_page("html", Options())
    steps = steps[: [n for n, _ in steps].index("rows") + 1]
    fields = {n: values[n] for n in ("article_text", "paragraph_text", "body_text")} | {"ld_body": article_body("html"), "n_rows": "size(rows)"}
    found = with_page(pages, steps, fields, "page_id").where("n_rows > 0")
    return found.selectExpr("page_id", f"{sql_baseline('ld_body')} AS text", "article_text", "paragraph_text")


def sql_baseline(body: str) -> str:
    """JSON-LD article body, then first article, distinct paragraphs, whole body."""
    return f"coalesce({body}, nullif(article_text, ''), nullif(paragraph_text, ''), nullif(body_text, ''))"


def extract_pages(pages: DataFrame, o: Options = Options()) -> DataFrame:
    """(page_id, text, choice, comments, n_chars, seconds, fingerprint) per page.

    Only the text of the choice is put together. A page without any text row gives a row without a text.
    """
    steps, values = sql_page("html", o)
    steps = steps + [(n, values[n]) for n in LENGTHS] + choice_steps(o)
    baseline = bind(sql_baseline(article_body("html")), "", {n: f"({values[n]})" for n in ("article_text", "paragraph_text", "body_text")})
    text = f"""case choice when 'own' then {values['own_text']} when 'scored' then {values['scored_text']}
      when 'classified' then {values['good_text']} else {baseline} end"""
    found = with_page(pages, steps, {"text": text, "choice": "choice", "comments": values["comments"]}, "page_id")
    return found.selectExpr(
        "*",
        "cast(length(text) as bigint) AS n_chars",
        f"{sql_reading_time('text')} AS seconds",
        f"{sql_fingerprint('text')} AS fingerprint",
    )


def page_digest(pages: DataFrame) -> DataFrame:
    """(page_id, digest, title, text, blocks, seconds, fingerprint): the short cascade.

    Main region only, no scoring and no recovery. One exchange of the raw rows.
    """
    rows = prune.page_blocks(pages, "boilerplate", *prune.REGIONS)
    rows = prune.drop_sections(markup.drop_containers(rows, images=True), "boilerplate").where("text_len > 0 and role <> 'caption'")
    found = prune.main_region(rows).groupBy("page_id").agg(
        F.expr(gather("true", "text")).alias("text"),
        F.expr("min(case when tag = 'h1' and not closing then named_struct('o', pos, 'v', text) end).v").alias("title"),
        F.count(F.lit(1)).alias("blocks"),
    )
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.selectExpr("page_id", "md5(url) AS digest").repartition(n, "page_id")
    return urls.join(found, "page_id", "left").selectExpr(
        "page_id", "digest", "title", "text", "coalesce(blocks, 0) AS blocks", f"{sql_reading_time('text')} AS seconds", f"{sql_fingerprint('text')} AS fingerprint"
    )
