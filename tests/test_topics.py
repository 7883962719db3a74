"""Stems, registered domains, and invariants of the topic models."""

import glob
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.functions.domains import RULES, domain_of_host, registered_domains
from pageloom.functions.stem import with_stem
from pageloom.operators import blocks, corpus, topics, variational
from pageloom.session import shared_root

# Pairs of the published description of the algorithm.
STEMS = {
    "caresses": "caress", "ponies": "poni", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit", "radicalli": "radic", "vietnamization": "vietnam",
    "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "adjustable": "adjust",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "is": "is", "as": "as", "syzygy": "syzygi", "a": "a",
}


def test_stems_of_the_published_examples(spark):
    got = with_stem(spark.createDataFrame([(w, 1) for w in STEMS], "w string, n int").withColumnRenamed("w", "word"), "word").collect()
    assert {r.word: r.stem for r in got} == STEMS


def test_stems_add_up_in_their_document(spark):
    docs = spark.createDataFrame([(1, "running runs run"), (2, "run jumped"), (3, None), (4, "jumps")], "doc_id long, text string")
    assert sorted(map(tuple, corpus.term_rows(docs, stem=True).collect())) == [(1, "run", 3), (2, "jump", 1), (2, "run", 1), (4, "jump", 1)]
    assert sorted(map(tuple, corpus.stem_counts(docs).collect())) == [("jump", 2, 2), ("run", 2, 4)]


DOMAINS = {
    "a.co.uk": "a.co.uk", "x.a.co.uk": "a.co.uk", "b.co.uk": "b.co.uk", "co.uk": "co.uk", "uk": "uk", "www.example.org": "example.org", "example.org": "example.org", "localhost": "localhost",
    "x.y.ck": "x.y.ck", "a.x.y.ck": "x.y.ck", "y.ck": "y.ck", "www.ck": "www.ck", "a.www.ck": "www.ck", "city.kawasaki.jp": "city.kawasaki.jp", "b.c.kawasaki.jp": "b.c.kawasaki.jp", "a.b.c.kawasaki.jp": "b.c.kawasaki.jp",
    "10.0.0.1": "10.0.0.1", "": "",
}


def test_registered_domains_by_list_and_by_table(spark):
    hosts = spark.createDataFrame([(h,) for h in DOMAINS], "host string")
    assert {r.host: r.d for r in hosts.select("host", domain_of_host(F.col("host")).alias("d")).collect()} == DOMAINS
    rules = spark.createDataFrame([(r,) for r in RULES + RULES[:3]], "rule string")
    assert {r.host: r.domain for r in registered_domains(hosts, rules).collect()} == DOMAINS
    own = spark.createDataFrame([("b.example",), ("!x.b.example",)], "rule string")
    got = registered_domains(spark.createDataFrame([("q.a.b.example",), ("x.b.example",), ("b.example",), (None,)], "host string"), own)
    assert {r.host: r.domain for r in got.collect()} == {"q.a.b.example": "a.b.example", "x.b.example": "x.b.example", "b.example": "b.example"}


def planted(spark, n=90):
    draw = random.Random(4)
    words = [[f"{name}{c}word" for c in "abcdefgh"] for name in ("sea", "sky", "hill")]
    rows = [(i, " ".join(draw.choice(words[i % 3]) for _ in range(40)) + (" shared" if i % 5 else "")) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None), (n + 1, "")], "doc_id long, text string")


def test_gamma_functions():
    x = np.array([0.01, 0.2, 1.0, 2.5, 7.0, 1e4])
    assert np.allclose(variational.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-9)
    assert np.allclose(variational.digamma(x), [(math.lgamma(v + v * 1e-5) - math.lgamma(v - v * 1e-5)) / (2e-5 * v) for v in x], rtol=1e-4, atol=1e-4)


def test_lda_finds_planted_topics_and_its_bound_rises(spark):
    docs = planted(spark)
    _, weights, bounds = topics.lda_model(docs, k=3, max_iter=8, seed=3, bound=True)
    assert len(bounds) == 8 and all(b >= a - 1e-6 * abs(a) for a, b in zip(bounds, bounds[1:])) and bounds[-1] > bounds[0]
    assert weights.count() == 25
    shown = topics.lda_topics(docs, k=3, max_iter=8, top=8, seed=3).collect()
    groups = [{r.term[:3] for r in shown if r.topic == t} for t in range(3)]
    assert sorted(map(sorted, groups)) == [["hil"], ["sea"], ["sky"]]
    again = topics.lda_topics(docs.repartition(3), k=3, max_iter=8, top=8, seed=3).collect()
    assert sorted((r.topic, r.term, round(r.weight, 6)) for r in shown) == sorted((r.topic, r.term, round(r.weight, 6)) for r in again)


def test_lda_of_nothing(spark):
    assert topics.lda_topics(planted(spark).limit(0), k=2, max_iter=1).count() == 0


def test_nmf_error_falls_and_equals_numpy(spark):
    weights = corpus.tfidf(planted(spark, 45))
    docs, terms, errors = topics.nmf_model(weights, k=3, iterations=4, least_gain=0)
    assert len(errors) == 4 and all(b <= a + 1e-9 for a, b in zip(errors, errors[1:]))
    rows = weights.collect()
    d, t = sorted({r.doc_id for r in rows}), sorted({r.term for r in rows})
    v = np.zeros((len(d), len(t)))
    for r in rows:
        v[d.index(r.doc_id), t.index(r.term)] = r.weight
    start = lambda names, key, kind: {r[0]: r[1:] for r in spark.createDataFrame([(n,) for n in names], f"{key} {kind}").select(key, *topics._start(key, 3)).collect()}
    w0, h0 = start(d, "doc_id", "long"), start(t, "term", "string")
    w, h = np.array([w0[x] for x in d]), np.array([h0[x] for x in t])
    for error in errors:
        w = w * (v @ h) / (w @ (h.T @ h) + 1e-9)
        assert abs(((v - w @ h.T) ** 2).sum() - error) < 1e-6
        h = h * (v.T @ w) / (h @ (w.T @ w) + 1e-9)
    got = {r.doc_id: [r.f0, r.f1, r.f2] for r in docs.collect()}
    assert np.allclose([got[x] for x in d], w, atol=1e-6)


def test_documents_fitted_side_by_side_are_those_fitted_alone():
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 40, 30)
    topics, counts, starts = draw.gamma(1, 1, (3, sizes.sum())) / 100, draw.integers(1, 5, sizes.sum()).astype(float), np.cumsum(sizes) - sizes
    gamma, share, bound = variational.fit_documents(counts, topics, sizes, 0.3)
    alone = [variational.fit_documents(counts[a : a + n], topics[:, a : a + n], np.array([n]), 0.3) for a, n in zip(starts, sizes)]
    assert np.allclose(gamma, np.vstack([g for g, _, _ in alone])) and np.allclose(share, np.hstack([s for _, s, _ in alone]))
    assert math.isclose(bound, sum(b for _, _, b in alone)) and np.allclose(share.sum(axis=0), counts)


def test_a_term_meets_a_block_once_and_rounds_leave_no_files(spark, monkeypatch):
    """However many documents hold a term, its factors go to their block once."""
    rows = spark.createDataFrame([(d, t, 1.0) for d in range(60) for t in range(5)] + [(None, 7, 1.0)], "doc long, id int, amount double")
    found = blocks.Blocks(rows)
    assert found.wanted.selectExpr("sum(size(blocks))").first()[0] <= 5 * found.n
    seen = lambda held: (np.repeat([0, 2], [len(held.ids), 1]), np.append(held.ids, 0), np.append(np.bincount(held.at, held.amounts, len(held.ids)), len(held.docs))[:, None])
    factors = spark.createDataFrame([(t, 1.0) for t in range(8)], "id int, f0 double")
    assert sorted(map(tuple, found.meet(factors, 1, seen).collect())) == [(0, t, 60.0) for t in range(5)] + [(2, 0, 60.0)]
    found.drop()
    made = []
    monkeypatch.setattr(topics, "written", lambda df, name: made.append(blocks.written(df, name)) or made[-1])
    folders = lambda name: [f for f in glob.glob(f"{shared_root(spark)}/{name}-*/_SUCCESS")]
    before = len(folders("nmf-sums"))
    topics.nmf_model(corpus.tfidf(planted(spark, 30)), k=2, iterations=3, least_gain=0)
    assert len([m for m in made if "nmf-sums" in m.inputFiles()[0]]) == 3 and len(folders("nmf-sums")) == before + 1


def test_nmf_of_texts_equals_nmf_of_their_weights(spark):
    docs = planted(spark, 30).unionAll(spark.createDataFrame([(3, "sky twice here here"), (None, "seaaword without a key")], "doc_id long, text string"))
    a, b = topics.nmf_model(corpus.tfidf(docs), k=2, iterations=2, least_gain=0), topics.nmf_of_texts(docs, 2, 2, least_gain=0)
    assert np.allclose(a[2], b[2])
    for x, y in zip(a[:2], b[:2]):
        x, y = sorted(map(tuple, x.collect())), sorted(map(tuple, y.collect()))
        assert [r[0] for r in x] == [r[0] for r in y] and np.allclose([r[1:] for r in x], [r[1:] for r in y])


def test_words_are_sorted_natively_and_analysed_once_for_stems(spark):
    docs = spark.createDataFrame([(1, "running runs run"), (2, "run jumped")], "doc_id long, text string")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan(corpus.with_terms(docs))
    assert "regexp_extract_all" not in plan(corpus.stem_counts(docs))


def test_rows_go_to_their_blocks_without_null_lists(spark):
    """A batch with null lists takes time as the square of its rows on its way to Python."""
    found = blocks.Blocks(spark.createDataFrame([(d, t, 1.0) for d in range(6) for t in range(5)], "doc long, id int, amount double"))
    met = found.meet(spark.createDataFrame([(t, 1.0) for t in range(5)], "id int, f0 double"), 1, lambda held: ([0] * len(held.ids), held.ids, held.factors))
    plan = met._jdf.queryExecution().analyzed().toString()
    assert "cast(null as double)" in plan and "cast(null as array" not in plan
    found.drop()


def test_documents_of_like_size_are_fitted_together():
    sizes = np.random.default_rng(3).integers(1, 9000, 700)
    parts = variational._side_by_side(sizes)
    assert sorted(np.concatenate(parts)) == list(range(700)) and len(parts) < 700
    for part in parts:
        assert len(part) == 1 or len(part) * sizes[part].max() <= variational.PLACES
        assert sizes[part].max() <= max(sizes[part].min() * 4 / 3, sizes[part].min() + 8)


def test_passes_over_terms_and_documents_give_the_same_weights(spark, monkeypatch):
    """Shuffles of one part of the terms lie on the disks at a time; rows and dictionary go once the weights are made."""
    docs = planted(spark, 30).unionAll(spark.createDataFrame([(3, "sky twice here here"), (None, "seaaword without a key"), (None, "seaaword twice here")], "doc_id long, text string"))
    rounded = lambda df: sorted((r.doc_id is None, r.doc_id or 0, r.term, round(r.weight, 9)) for r in df.collect())
    one, nmf = rounded(corpus.tfidf(docs)), topics.nmf_of_texts(docs, 2, 2, least_gain=0)[2]
    monkeypatch.setattr(corpus, "PASS_ROWS", 200)
    assert len(corpus.tfidf_parts(docs)[2]) > 2
    made = {}

    def kept(rows, name):
        out = blocks.written(rows, name)
        made[out.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/")] = name
        return out

    monkeypatch.setattr(corpus, "written", kept)
    assert rounded(corpus.tfidf(docs)) == one
    assert np.allclose(topics.nmf_of_texts(docs, 2, 2, least_gain=0)[2], nmf)
    assert {n for n in made.values()} == {"terms", "dictionary", "weights", "tfidf"}
    left = [(f, n, glob.glob(f"{f}/*")) for f, n in made.items() if n != "tfidf" and glob.glob(f"{f}/*")]
    assert not left, left
