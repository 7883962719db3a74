"""Queries that score containers. The check SQL joins rows to containers by position range
and groups, where the plan uses running sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import score
from pageloom.plans import markup_sql as d
from pageloom.plans.markup_queries import rich_blocks
from pageloom.plans.registry import cte, query


def d_count(pattern: str) -> str:
    return f"len(regexp_extract_all(inner_html, '{pattern}', 0))"


def d_class_weight(tag: str) -> str:
    parts = []
    for name in ("class", "id"):
        v = d.d_attr(tag, name)
        parts.append(f"case when regexp_matches({v}, '{score.NEGATIVE}') then -25 else 0 end")
        parts.append(f"case when regexp_matches({v}, '{score.POSITIVE}') then 25 else 0 end")
    return f"case when closing then 0 else {' + '.join(parts)} end"


MEASURES = f"""length(text) - length(replace(text, ',', '')) AS commas,
  case when (tag = 'p' and not closing) or (role = 'div' and text_len > 0) then 1 else 0 end AS n_p,
  case when tag = 'li' and not closing then 1 else 0 end AS n_li, {d_count('(?i)<img[\\s>/]')} AS n_img,
  {d_count('(?i)<input[\\s>/]')} - {d_count('(?i)<input[^>]*type\\s*=\\s*.?hidden')} AS n_input,
  {d_count('(?i)<embed[\\s>/]')} AS n_embed, {d_class_weight('open_tag')} AS class_weight"""


def scored_ctes(prefix: str, source: str) -> None:
    """mrow: measured rows; span: containers with end; stat: subtree sums; scored: scores."""
    cte(f"{prefix}mrow", f"SELECT *, {MEASURES} FROM {source}")
    cte(
        f"{prefix}span",
        f"""SELECT c.page_id, c.pos, c.tag, c.parent_id, c.depth, c.class_weight, coalesce(min(e.pos), 1000000000) AS end_pos
FROM {prefix}mrow c LEFT JOIN {prefix}mrow e ON e.page_id = c.page_id AND e.pos > c.pos AND e.closes AND e.depth = c.depth - 1
WHERE c.opens GROUP BY ALL""",
    )
    sums = ", ".join(f"cast(sum(b.{c}) as bigint) AS sub_{c}" for c in score.SUBTREE)
    cte(
        f"{prefix}stat",
        f"""SELECT s.page_id, s.pos, s.tag, s.parent_id, s.depth, s.class_weight, s.end_pos, {sums}
FROM {prefix}span s JOIN {prefix}mrow b ON b.page_id = s.page_id AND b.pos >= s.pos AND b.pos < s.end_pos GROUP BY ALL""",
    )
    whens = " ".join(f"when tag in {d.tags(t)} then {p}" for t, p in score.TAG_POINTS)
    cte(
        f"{prefix}scored",
        f"""SELECT s.*, (200 * (s.class_weight + case {whens} else 0 end) + g.pts) / 200.0::double * (1 - sub_link_len / greatest(sub_text_len, 1)::double) AS score
FROM {prefix}stat s JOIN (
  SELECT page_id, id, sum(pts) AS pts FROM (
    SELECT page_id, container_id AS id, 200 * (2 + commas) + 2 * least(text_len, 300) AS pts FROM {prefix}par
    UNION ALL SELECT page_id, parent_id, 100 * (2 + commas) + least(text_len, 300) FROM {prefix}par) GROUP BY ALL) g
ON g.page_id = s.page_id AND g.id = s.pos""",
    )
    cte(
        f"{prefix}par",
        f"SELECT * FROM {prefix}mrow WHERE ((tag in ('p', 'pre', 'td') and not closing) or role = 'div') and text_len >= {score.MIN_PARAGRAPH}",
    )
    cte(
        f"{prefix}best",
        f"""SELECT page_id, pos AS best_id, parent_id AS up, score AS best_score, end_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS rn FROM {prefix}scored) WHERE rn = 1""",
    )
    cte(
        f"{prefix}picked",
        f"""SELECT s.page_id, s.pos, s.end_pos FROM {prefix}scored s JOIN {prefix}best b ON b.page_id = s.page_id
WHERE s.pos = b.best_id or (s.parent_id = b.up and s.score >= greatest(10.0, b.best_score * 0.2::double))""",
    )
    cte(
        f"{prefix}kept_rows",
        f"""SELECT r.* FROM {prefix}mrow r JOIN {prefix}best b ON b.page_id = r.page_id WHERE r.text_len > 0 and (
  EXISTS (SELECT 1 FROM {prefix}picked p WHERE p.page_id = r.page_id AND r.pos >= p.pos AND r.pos < p.end_pos)
  or ((r.tag = 'p' or (r.role = 'div' and r.closing)) and not r.opens and r.container_id = b.up and
    ((r.text_len > 80 and r.link_len < 0.25::double * r.text_len) or (r.text_len between 1 and 80 and r.link_len = 0 and regexp_matches(r.text, '\\.( |$)')))))""",
    )
    density = "(sub_link_len / greatest(sub_text_len, 1)::double)"
    cte(
        f"{prefix}reasons",
        f"""SELECT *, case when tag not in {d.tags(score.CLEANED_TAGS)} then null
  when class_weight + coalesce(score, 0) < 0 then 'negative' when sub_commas >= 10 then null
  when sub_n_p > 0 and sub_n_img > 1 + 1.3::double * sub_n_p then 'images'
  when sub_n_li - 100 > sub_n_p and tag <> 'ul' then 'items' when sub_n_input > sub_n_p / 3.0::double then 'inputs'
  when sub_text_len < {score.MIN_PARAGRAPH} and (sub_n_img = 0 or sub_n_img > 2) then 'short'
  when class_weight < 25 and {density} > 0.2::double then 'links' when class_weight >= 25 and {density} > 0.5::double then 'links'
  when (sub_n_embed = 1 and sub_text_len < 75) or sub_n_embed > 1 then 'embed'
  when sub_text_len = 0 and coalesce((SELECT arg_min(x.size, x.pos) FROM {prefix}element x WHERE x.page_id = t.page_id and x.up = t.parent_id and x.pos > t.pos and x.size > 0), 0)
    + coalesce((SELECT arg_max(x.size, x.pos) FROM {prefix}element x WHERE x.page_id = t.page_id and x.up = t.parent_id and x.pos < t.pos and x.size > 0), 0) <= 1000 then 'empty' end AS drop_reason
FROM (SELECT s.*, c.score FROM {prefix}stat s LEFT JOIN {prefix}scored c ON c.page_id = s.page_id AND c.pos = s.pos) t""",
    )
    cte(
        f"{prefix}element",
        f"""SELECT page_id, pos, parent_id AS up, sub_text_len AS size FROM {prefix}stat
UNION ALL SELECT page_id, pos, container_id, text_len FROM {prefix}mrow WHERE not opens and not closing""",
    )


scored_ctes("", "blk")


def scored(spark, sf_dir):
    return score.scored_rows(rich_blocks(spark, sf_dir))


@query(
    "score_containers",
    "D20",
    "SELECT s.page_id, s.pos, s.tag, s.sub_text_len, s.sub_link_len, round(s.score, 6) AS score, cast(s.pos = b.best_id as int) AS best "
    "FROM scored s JOIN best b ON b.page_id = s.page_id",
)
def q_score_containers(spark, sf_dir):
    return scored(spark, sf_dir).where("score is not null").selectExpr(
        "page_id", "pos", "tag", "sub_text_len", "sub_link_len", "round(score, 6) AS score", "cast(pos = best_id as int) AS best"
    )


@query("sibling_blocks", "D21", "SELECT page_id, pos, text FROM kept_rows")
def q_sibling_blocks(spark, sf_dir):
    return scored(spark, sf_dir).where("kept").select("page_id", "pos", "text")


@query("drop_unlikely", "D22", "SELECT page_id, pos, text FROM blk WHERE in_unlikely = 0")
def q_drop_unlikely(spark, sf_dir):
    return score.drop_unlikely(rich_blocks(spark, sf_dir, "unlikely")).select("page_id", "pos", "text")


@query(
    "container_clean_reasons",
    "D23",
    "SELECT page_id, pos, tag, drop_reason, sub_n_p, sub_n_img, sub_n_li, sub_n_input FROM reasons",
)
def q_container_clean_reasons(spark, sf_dir):
    return scored(spark, sf_dir).where("opens").select(
        "page_id", "pos", "tag", "drop_reason", "sub_n_p", "sub_n_img", "sub_n_li", "sub_n_input"
    )


@query(
    "clean_containers",
    "D23",
    """SELECT page_id, pos, text FROM kept_rows r WHERE NOT EXISTS (
  SELECT 1 FROM reasons x WHERE x.page_id = r.page_id and x.drop_reason is not null and r.pos >= x.pos and r.pos < x.end_pos)""",
)
def q_clean_containers(spark, sf_dir):
    return score.clean_containers(scored(spark, sf_dir)).where("kept").select("page_id", "pos", "text")


@query(
    "clean_scored",
    "D31",
    "SELECT page_id, pos, text FROM mrow WHERE in_form = 0 and not (role = 'head' and (class_weight < 0 or link_len > 0.33::double * greatest(text_len, 1)))",
)
def q_clean_scored(spark, sf_dir):
    df = rich_blocks(spark, sf_dir).withColumn("class_weight", F.expr(score.sql_class_weight()))
    return score.clean_scored(df).select("page_id", "pos", "text")
