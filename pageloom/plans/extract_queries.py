"""Queries of the page cascade and its parts."""

from __future__ import annotations

from pageloom.functions.stopwords import stop_words
from pageloom.operators import markup, paragraphs, prune, score
from pageloom.plans import extract
from pageloom.plans import markup_sql as d
from pageloom.plans.markup_queries import KEEP, rich, rich_blocks
from pageloom.plans.prune_queries import TEXT_OK, d_link_density, d_main_region, d_repeated, d_trim_tail
from pageloom.plans.registry import cte, query
from pageloom.plans.tables import load
from pageloom.plans.score_queries import scored_ctes
from pageloom.plans.text_queries import d_fingerprint, d_reading_time

AREAS = prune.COMMENT_AREAS


def d_area(quiet: str) -> str:
    found = ", ".join(
        f"case when sum(case when {quiet} and in_{a} > 0 and text_len > 0 then 1 else 0 end) OVER (PARTITION BY page_id) > 0 then {i} end"
        for i, a in enumerate(AREAS, 1)
    )
    return f"coalesce({found})"


IN_AREA = "coalesce(case comment_area " + " ".join(f"when {i} then in_{a} > 0" for i, a in enumerate(AREAS, 1)) + " end, false)"
QUIET = "(in_comment_noise = 0 and text_len > 0)"

cte("area_rows", f"SELECT *, {d_area(QUIET)} AS comment_area FROM blk")


@query("comment_rows", "D17", f"SELECT page_id, pos, comment_area, text FROM area_rows WHERE {QUIET} and {IN_AREA}")
def q_comment_rows(spark, sf_dir):
    rows = rich_blocks(spark, sf_dir, "comment_noise", *AREAS)
    return prune.comment_rows(rows).select("page_id", "pos", "comment_area", "text")


# Own extraction as a chain of filters.
cte("clean_rows", f"SELECT * FROM area_rows WHERE {KEEP} and in_table = 0 and in_figure = 0")
cte(
    "guarded_rows",
    """SELECT * FROM (SELECT *, sum(case when in_boilerplate > 0 then 0 else text_len end) OVER (PARTITION BY page_id) * 7
  > sum(text_len) OVER (PARTITION BY page_id) AS enough FROM (SELECT * FROM clean_rows WHERE not """
    + IN_AREA
    + """)) WHERE not (in_boilerplate > 0 and enough) and in_paywall = 0 and in_caption = 0 and in_teaser = 0""",
)
cte("dense_divs", d_link_density("guarded_rows", "'div'"))
cte("dense_reps", f"SELECT * EXCLUDE (max_len) FROM ({d_repeated('dense_divs')})")
cte("pruned_rows", f"SELECT * FROM ({d_link_density('dense_reps', chr(39) + 'p' + chr(39) + ', ' + chr(39) + 'item' + chr(39))}) WHERE {TEXT_OK}")
cte(
    "admitted_rows",
    """SELECT * EXCLUDE (p_chars) FROM (SELECT *, coalesce(sum(case when role = 'p' then text_len end) OVER (PARTITION BY page_id), 0) AS p_chars FROM pruned_rows)
WHERE role <> 'div' or p_chars < 750""",
)
cte("region_rows", d_main_region("admitted_rows"))
cte("own_core", d_trim_tail("region_rows"))
cte("own_core_len", "SELECT page_id, sum(text_len + 1) - 1 AS n FROM own_core GROUP BY page_id")
cte(
    "own_rows",
    """SELECT p.* FROM pruned_rows p LEFT JOIN own_core_len l ON l.page_id = p.page_id
WHERE EXISTS (SELECT 1 FROM own_core o WHERE o.page_id = p.page_id and o.pos = p.pos) or (p.role in ('p', 'quote') and coalesce(l.n, -1) < 250)""",
)


@query("recover_text", "D18", "SELECT page_id, pos, role, text FROM own_rows")
def q_recover_text(spark, sf_dir):
    return extract.picked_rows(rich(spark, sf_dir), "own")


cte(
    "first_paragraphs",
    """SELECT page_id, min(pos) AS pos, text FROM blk WHERE in_aside = 0 and in_footer = 0 and text_len > 0 and role in ('p', 'quote')
GROUP BY page_id, text""",
)
cte(
    "baseline_parts",
    f"""SELECT p.page_id, nullif({d.d_trim_ws("replace(regexp_extract(array_to_string(regexp_extract_all(html, '" + extract.LD_SCRIPT + "', 1), ' '), '" + extract.ARTICLE_BODY + "', 1), chr(92) || chr(34), chr(34))")}, '') AS ld_body,
  a.text AS article_text, f.text AS paragraph_text, b.text AS body_text
FROM rich_pages p
LEFT JOIN (SELECT page_id, string_agg(text, ' ' ORDER BY pos) AS text FROM blk WHERE in_aside = 0 and in_footer = 0 and text_len > 0 and in_region2 > 0 GROUP BY page_id) a ON a.page_id = p.page_id
LEFT JOIN (SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS text FROM first_paragraphs GROUP BY page_id) f ON f.page_id = p.page_id
LEFT JOIN (SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS text FROM blk WHERE in_aside = 0 and in_footer = 0 and text_len > 0 GROUP BY page_id) b ON b.page_id = p.page_id""",
)


@query(
    "baseline_text",
    "D19",
    "SELECT page_id, coalesce(ld_body, article_text, paragraph_text, body_text) AS text, coalesce(article_text, '') AS article_text, "
    "coalesce(paragraph_text, '') AS paragraph_text FROM baseline_parts WHERE page_id in (SELECT page_id FROM blk)",
)
def q_baseline_text(spark, sf_dir):
    return extract.baseline_texts(rich(spark, sf_dir))


def d_classified(source: str) -> str:
    words = f"regexp_extract_all(lower(text), '{paragraphs.WORD}', 0)"
    share = f"case when len({words}) = 0 then 0 else len(list_filter({words}, lambda w: w in {d.tags(stop_words())})) / len({words})::double end"
    return f"""SELECT *, case when link_len > 0.2::double * text_len then 'bad' when regexp_matches(text, '{paragraphs.COPYRIGHT}') or contains(inner_html, '<select') then 'bad'
  when text_len < 50 then case when link_len > 0 then 'bad' else 'short' end
  when stop_share >= 0.2::double then case when text_len > 200 then 'good' else 'near' end when stop_share >= 0.1::double then 'near' else 'bad' end AS class
FROM (SELECT *, {share} AS stop_share FROM {source})"""


def d_revised(source: str) -> str:
    """Neighbours by correlated look-ups instead of fills."""
    def near(col: str, cond: str, side: str) -> str:
        op, agg = ("<", "arg_max") if side == "prev" else (">", "arg_min")
        return f"coalesce((SELECT {agg}(x.{col}, x.pos) FROM {{t}} x WHERE x.page_id = b.page_id and x.pos {op} b.pos and x.{cond}), 'bad')"

    a = source
    first = f"""SELECT b.*, case when class <> 'short' then class
  when {near('class', "class in ('good', 'bad')", 'prev').format(t=a)} = {near('class', "class in ('good', 'bad')", 'next').format(t=a)} then {near('class', "class in ('good', 'bad')", 'prev').format(t=a)}
  when ({near('class', "class in ('good', 'bad')", 'prev').format(t=a)} = 'bad' and {near('class', "class <> 'short'", 'prev').format(t=a)} = 'near')
    or ({near('class', "class in ('good', 'bad')", 'next').format(t=a)} = 'bad' and {near('class', "class <> 'short'", 'next').format(t=a)} = 'near') then 'good'
  else 'bad' end AS first_class FROM {a} b"""
    return first


cte("classed_rows", d_classified("(SELECT * FROM blk WHERE text_len > 0)"))
cte("first_pass", d_revised("classed_rows"))
SECOND = """case when first_class <> 'near' then first_class
  when coalesce((SELECT arg_max(x.first_class, x.pos) FROM {t} x WHERE x.page_id = b.page_id and x.pos < b.pos and x.first_class <> 'near'), 'bad') = 'bad'
   and coalesce((SELECT arg_min(x.first_class, x.pos) FROM {t} x WHERE x.page_id = b.page_id and x.pos > b.pos and x.first_class <> 'near'), 'bad') = 'bad' then 'bad' else 'good' end"""


@query("classify_blocks", "D24", "SELECT page_id, pos, round(stop_share, 6) AS stop_share, class FROM classed_rows")
def q_classify_blocks(spark, sf_dir):
    rows = markup.drop_empty(rich_blocks(spark, sf_dir))
    return paragraphs.classify_blocks(rows).selectExpr("page_id", "pos", "round(stop_share, 6) AS stop_share", "class")


@query(
    "revise_blocks",
    "D25",
    f"SELECT page_id, pos, class, {SECOND.format(t='first_pass')} AS final_class FROM first_pass b",
)
def q_revise_blocks(spark, sf_dir):
    rows = paragraphs.classify_blocks(markup.drop_empty(rich_blocks(spark, sf_dir)))
    return paragraphs.revise_blocks(rows).select("page_id", "pos", "class", "final_class")


# The given pages, without the derived wrapping, go through the same cascade.
cte("good_cand", d_classified(f"(SELECT * FROM clean_rows WHERE in_paywall = 0 and in_comments = 0 and text_len > 0)"))
cte("good_first", d_revised("good_cand"))
cte("good_rows", f"SELECT * FROM (SELECT b.*, {SECOND.format(t='good_first')} AS final_class FROM good_first b) WHERE final_class = 'good'")

scored_ctes("strict_", "(SELECT * REPLACE (case when in_unlikely > 0 or in_paywall > 0 then 0 else text_len end AS text_len, "
    "case when in_unlikely > 0 or in_paywall > 0 then 0 else link_len end AS link_len, case when in_unlikely > 0 or in_paywall > 0 then '' else text END AS text, "
    "case when in_unlikely > 0 or in_paywall > 0 then '' else inner_html end AS inner_html, case when in_unlikely > 0 or in_paywall > 0 then 'dead' else tag end AS tag, "
    "case when in_unlikely > 0 or in_paywall > 0 then 'dead' else role end AS role) FROM blk)")
scored_ctes("loose_", "(SELECT * REPLACE (case when in_paywall > 0 then 0 else text_len end AS text_len, "
    "case when in_paywall > 0 then 0 else link_len end AS link_len, case when in_paywall > 0 then '' else text END AS text, "
    "case when in_paywall > 0 then '' else inner_html end AS inner_html, case when in_paywall > 0 then 'dead' else tag end AS tag, "
    "case when in_paywall > 0 then 'dead' else role end AS role) FROM blk)")


def d_article(prefix: str) -> str:
    return f"""SELECT r.page_id, r.pos, r.text_len, r.role FROM {prefix}kept_rows r WHERE in_form = 0
  and not (role = 'head' and (class_weight < 0 or link_len > 0.33::double * greatest(text_len, 1)))
  and NOT EXISTS (SELECT 1 FROM {prefix}reasons x WHERE x.page_id = r.page_id and x.drop_reason is not null and r.pos >= x.pos and r.pos < x.end_pos)"""


cte("strict_article", d_article("strict_"))
cte("loose_article", d_article("loose_"))
cte("strict_len", "SELECT page_id, sum(text_len) AS n FROM strict_article GROUP BY page_id")
cte(
    "article_rows",
    """SELECT b.* FROM blk b LEFT JOIN strict_len l ON l.page_id = b.page_id WHERE case when coalesce(l.n, 0) >= 250
  then EXISTS (SELECT 1 FROM strict_article a WHERE a.page_id = b.page_id and a.pos = b.pos)
  else EXISTS (SELECT 1 FROM loose_article a WHERE a.page_id = b.page_id and a.pos = b.pos) end""",
)
cte("article_known", f"SELECT * FROM article_rows WHERE {KEEP} and in_table = 0 and in_figure = 0")
cte(
    "lengths",
    """SELECT p.page_id, coalesce(o.n, 0) AS own_len, coalesce(s.n, 0) AS scored_len, coalesce(k.n, 0) AS plain_len, coalesce(g.n, 0) AS good_len,
  coalesce(o.p_len, 0) AS own_p_len, coalesce(o.ps, 0) AS own_ps, coalesce(o.tables, 0) AS own_tables, coalesce(s.rows_all, 0) - coalesce(k.rows_all, 0) AS scored_noise
FROM (SELECT DISTINCT page_id FROM blk) p
LEFT JOIN (SELECT page_id, sum(text_len + 1) - 1 AS n, sum(case when role = 'p' then text_len end) AS p_len, count_if(role = 'p') AS ps,
  count(distinct case when table_no > 0 then table_no end) AS tables FROM own_rows GROUP BY page_id) o ON o.page_id = p.page_id
LEFT JOIN (SELECT page_id, sum(text_len + 1) - 1 AS n, count(*) AS rows_all FROM article_rows GROUP BY page_id) s ON s.page_id = p.page_id
LEFT JOIN (SELECT page_id, sum(text_len + 1) - 1 AS n, count(*) AS rows_all FROM article_known GROUP BY page_id) k ON k.page_id = p.page_id
LEFT JOIN (SELECT page_id, sum(text_len + 1) - 1 AS n FROM good_rows GROUP BY page_id) g ON g.page_id = p.page_id""",
)
LENGTH_COLS = "page_id, own_len, scored_len, plain_len, good_len, own_p_len, own_ps, own_tables, scored_noise"
cte(
    "chosen",
    """SELECT *, case when case pick when 'classified' then good_len when 'scored' then plain_len else own_len end < 250 then 'baseline' else pick end AS choice FROM (
SELECT *, case when (case when scored_wins then scored_len else own_len end < 250 or (scored_wins and scored_noise > 0)) and good_len > 0 then 'classified'
  when scored_wins then 'scored' else 'own' end AS pick FROM (
SELECT *, case when scored_len in (0, own_len) then false when own_len = 0 then true when own_len > 2 * scored_len then false when scored_len > 2 * own_len then true
  else scored_len > 500 and (own_p_len = 0 or own_tables > own_ps) end AS scored_wins FROM lengths))""",
)
INT_COLS = ", ".join(f"cast({c} as bigint) AS {c}" for c in LENGTH_COLS.split(", ")[1:])


@query("choose_extraction", "D26", f"SELECT page_id, {INT_COLS}, choice FROM chosen")
def q_choose_extraction(spark, sf_dir):
    df = extract.choose_extraction(extract.candidate_lengths(rich(spark, sf_dir)))
    return df.selectExpr("page_id", *INT_COLS.split(", "), "choice")


@query("sanitize_scored", "D32", "SELECT page_id, pos, role, text FROM article_known")
def q_sanitize_scored(spark, sf_dir):
    return extract.picked_rows(rich(spark, sf_dir), "scored_known")


@query("rescue_rows", "D33", "SELECT page_id, pos, text FROM good_rows")
def q_rescue_rows(spark, sf_dir):
    return extract.picked_rows(rich(spark, sf_dir), "good")


cte("own_lines", d.d_render("own_rows"))
cte("scored_lines", d.d_render("article_known"))
cte(
    "extracted",
    f"""SELECT c.page_id, c.choice, case c.choice when 'own' then coalesce(o.text, '') when 'scored' then coalesce(s.text, '') when 'classified' then coalesce(g.text, '')
    else coalesce(ld_body, article_text, paragraph_text, body_text) end AS text, coalesce(m.text, '') AS comments
FROM chosen c JOIN baseline_parts b ON b.page_id = c.page_id
LEFT JOIN own_lines o ON o.page_id = c.page_id LEFT JOIN scored_lines s ON s.page_id = c.page_id
LEFT JOIN (SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS text FROM good_rows GROUP BY page_id) g ON g.page_id = c.page_id
LEFT JOIN (SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS text FROM clean_rows WHERE {QUIET} and {IN_AREA} GROUP BY page_id) m ON m.page_id = c.page_id""",
)


@query(
    "extract_pages",
    "D27",
    f"SELECT page_id, text, choice, comments, length(text) AS n_chars, {d_reading_time('text')} AS seconds, {d_fingerprint('text')} AS fingerprint FROM extracted",
)
def q_extract_pages(spark, sf_dir):
    return extract.extract_pages(rich(spark, sf_dir))


cte("plain_region", d_main_region(f"(SELECT * FROM plain_blk WHERE {KEEP} and in_boilerplate = 0 and text_len > 0 and role <> 'caption')"))
cte(
    "plain_digest",
    """SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS text, arg_min(text, pos) FILTER (tag = 'h1') AS title, count(*) AS blocks FROM plain_region GROUP BY page_id""",
)


@query(
    "page_digest",
    "D27",
    f"SELECT p.page_id, md5(p.url) AS digest, title, text, coalesce(blocks, 0) AS blocks, {d_reading_time('text')} AS seconds, {d_fingerprint('text')} AS fingerprint "
    "FROM pages p LEFT JOIN plain_digest t ON p.page_id = t.page_id",
)
def q_page_digest(spark, sf_dir):
    """Given pages -> rows -> main region -> title, text, reading time, fingerprint."""
    pages = load(spark, sf_dir, "pages")
    return extract.page_digest(pages)
