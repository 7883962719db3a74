import random

import numpy as np
import pytest

from pageloom.llm import decontaminate, graph, jaccard_join, substring_dedup
from tests.llm.plain import AWKWARD, PASSAGE, classes, frame, sha, shingles, without_repeats


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_repeats_of_awkward_rows(spark):
    want = [(key, n, k, left) for (key, *_), (n, k, left) in zip(AWKWARD, without_repeats([r[1] for r in AWKWARD], 35))]
    assert by_id(substring_dedup.remove_repeats(frame(spark)).collect()) == by_id(want)
    digests = [(key, n, k, sha(left)) for key, n, k, left in want]
    assert by_id(substring_dedup.repeat_digests(frame(spark)).collect()) == by_id(digests)


@pytest.mark.parametrize("key", [None, 5])
def test_texts_of_one_id_with_equal_short_hashes_keep_apart(spark, key):
    """Texts whose 32-bit hashes are equal: 1217 and 204328, 14813 and 65572."""
    other = " ".join(f"other{i}" for i in range(50))
    texts = [f"{PASSAGE} 1217", f"{other} 204328", f"{PASSAGE} 14813", "short 65572"]
    docs = frame(spark, [(key, t, None, None) for t in texts])
    assert docs.selectExpr("hash(cast(text as binary))").distinct().count() == 2
    got = substring_dedup.remove_repeats(docs).collect()
    assert by_id(got) == by_id((key, *w) for w in without_repeats(texts, 35))


def test_repeated_rows_are_judged_once(spark, monkeypatch):
    """Copies of a text with one id, or with null ids, share one list of runs, whatever their number."""
    lists, opening = [], substring_dedup._open
    monkeypatch.setattr(substring_dedup, "_open", lambda slim, listed, *args: lists.append(listed.collect()) or opening(slim, listed, *args))
    edit = PASSAGE.replace("passage40 ", "edit ")
    rows = [(1, PASSAGE)] * 6 + [(None, f"before {PASSAGE} after")] * 5 + [(2, edit), (3, "ok"), (3, "ok"), (None, None)]
    got = substring_dedup.remove_repeats(frame(spark, [(*r, None, None) for r in rows])).collect()
    assert by_id(got) == by_id((key, *w) for (key, _), w in zip(rows, without_repeats([t for _, t in rows], 35)))
    runs = [[r.pos for r in row.runs] for row in lists[0]]
    assert len(runs) <= 3 and all(len(at) == len(set(at)) for at in runs)


def test_repeats_of_no_rows(spark):
    assert substring_dedup.repeat_digests(frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_among_few_words_and_edited_copies(spark, seed):
    """Small vocabularies make runs, periods and overlaps; passages are placed whole, cut and edited."""
    rng = random.Random(seed)
    texts = []
    base = [" ".join(rng.choice("a b c dd".split()) for _ in range(80)) for _ in range(6)]
    for i in range(60):
        parts = [" ".join(rng.choice("a b e f g h".split()) for _ in range(rng.randint(0, 50)))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(base).split()
            start = rng.randint(0, 30)
            w = w[start : start + rng.randint(20, 60)]
            if rng.random() < 0.3 and w:
                w[rng.randrange(len(w))] = "edit"
            parts.append(" ".join(w))
        if i % 10 == 0:
            parts.append("ab cd " * rng.randint(10, 40))
        texts.append(" ".join(parts))
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    for window in (8, 35):
        got = substring_dedup.remove_repeats(frame(spark, rows), window=window).collect()
        assert by_id(got) == by_id([(i, *w) for i, w in enumerate(without_repeats(texts, window))])


def test_parts_of_a_long_text_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 40, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = substring_dedup.filed_windows(hashes, np.array([0, len(hashes)]), 35)

    def windows(found, offset):
        text, first, number, name, _ = found
        return [(offset + int(f) + i, int(n)) for f, k, n in zip(first, number, name) for i in range(int(k))]

    parts = []
    for at in range(0, len(hashes) - 34, 700):
        part = hashes[at : at + 700 + 34]
        parts += windows(substring_dedup.filed_windows(part, np.array([0, len(part)]), 35), at)
    assert sorted(parts) == sorted(windows(whole, 0))


def test_classes_of_awkward_rows(spark):
    got = jaccard_join.similarity_classes(frame(spark)).select("doc_id", "class_id", "n_links", "n_text_links").collect()
    assert by_id(got) == by_id(classes([(r[0], r[1]) for r in AWKWARD]))
    assert jaccard_join.similarity_classes(frame(spark).limit(0)).count() == 0


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_links_of_a_large_group_in_many_blocks(spark, monkeypatch):
    """Near copies of one text, chains of drifting texts and strangers; blocks so small that groups need several."""
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 7)
    rng = random.Random(7)
    base = " ".join(f"b{i}" for i in range(120))
    rows = [(i, edited(rng, base, rng.randint(0, 3))) for i in range(60)]
    drift = " ".join(f"c{i}" for i in range(200))
    for i in range(100, 120):
        rows.append((i, drift))
        drift = edited(rng, drift, 3)
    rows += [(i, " ".join(f"s{rng.randrange(10**6)}" for _ in range(60))) for i in range(200, 230)]
    rows += [(300 + i, rows[i][1]) for i in range(5)]
    got = jaccard_join.similarity_classes(frame(spark, [(*r, None, None) for r in rows])).select("doc_id", "class_id", "n_links", "n_text_links").collect()
    assert by_id(got) == by_id(classes(rows))


def test_one_of_each_class_stays(spark):
    kept = jaccard_join.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    want = {}
    for (key, text, *_), (_, least, *_) in zip(AWKWARD, classes([(r[0], r[1]) for r in AWKWARD])):
        if shingles(text) and key == least:
            want[least, text] = 1
    rows = kept.collect()
    texts = [r.text for r in rows]
    assert all(r._class == r._node == r._blank == r._text_node == r._row == "clash" for r in rows)
    assert sorted(t for t in texts if shingles(t)) == sorted(t for _, t in want)
    assert len([t for t in texts if not shingles(t)]) == 3


def test_classes_with_the_same_least_id_each_keep_one(spark):
    """Null ids and one id on unrelated texts: the class is known by its texts, not by its least id."""
    prose = {name: " ".join(f"{name}{i}" for i in range(60)) for name in "abcdef"}
    rows = [(5, prose["a"]), (5, prose["b"]), (9, prose["b"] + " more"), (None, prose["c"]), (None, prose["d"]), (None, prose["d"] + " more")]
    rows += [(None, prose["e"]), (7, prose["e"] + " more"), (None, prose["f"]), (None, prose["f"]), (5, None), (None, "")]
    docs = frame(spark, [(*r, None, None) for r in rows])
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one(docs).collect()]
    either = [r for r in kept if r[0] is None and (r[1] or "").startswith("d0 ")]
    assert len(either) == 1
    assert by_id(set(kept) - set(either)) == by_id([rows[i] for i in (0, 1, 3, 7, 8, 10, 11)])
    assert len(kept) == 8
    found = jaccard_join.similarity_classes(docs).where("class_node is not null").collect()
    assert by_id((r.doc_id, r.class_id) for r in found) == by_id((i, c) for (i, _), c in zip(rows, [5, 5, 5, None, None, None, 7, 7, None, None]))
    assert len({r.class_node for r in found}) == 6


def test_a_repeated_text_is_compared_once(spark, monkeypatch):
    """Repeated rows, and copies with null ids, send one n-gram set to their group."""
    sent, with_sets = [], jaccard_join._with_sets
    monkeypatch.setattr(jaccard_join, "_with_sets", lambda *args: sent.append(with_sets(*args)) or sent[-1])
    base = " ".join(f"r{i}" for i in range(60))
    rows = [(1, base)] * 6 + [(None, base + " more")] * 6 + [(2, base + " other")]
    got = jaccard_join.similarity_classes(frame(spark, [(*r, None, None) for r in rows])).select("doc_id", "class_id", "n_links", "n_text_links").collect()
    assert by_id(got) == by_id(classes(rows))
    assert sent[0].count() == 3


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        n_bands, n_rows = jaccard_join.bands(threshold, 0.9999)
        assert (1 - threshold**n_rows) ** n_bands <= 1e-4
        assert n_bands * n_rows <= jaccard_join.MOST_HASHES


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(40), rng.randrange(40)) for _ in range(25)] + [(7, 7), (500, 500), (None, 3)]
    edges += [(300, i) for i in range(301, 340)]
    root = {n: n for e in edges if None not in e for n in e}
    for _ in edges:
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    for a in root:
        while root[a] != root[root[a]]:
            root[a] = root[root[a]]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == root
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def contained(docs, items, threshold=0.8):
    out = []
    for d, text in docs:
        for i, item in items:
            own = shingles(item)
            k = min(5, len((item or "").split()))
            found = len(own & shingles(text, k)) if own else 0
            if own and found >= threshold * len(own):
                out.append((d, i, len(own), found))
    return out


def test_items_in_awkward_rows(spark):
    items = [(1, PASSAGE), (2, " ".join(PASSAGE.split()[:9])), (3, None), (4, ""), (5, "ok"), (6, "a a a"), (7, "nowhere to be found at all"), (None, "line one is here"), (1, PASSAGE)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_items(frame(spark), table).select("doc_id", "item_id", "n_shingles", "n_found").collect()
    assert by_id(got) == by_id(contained([(r[0], r[1]) for r in AWKWARD], items))
    kept = decontaminate.drop_contaminated(frame(spark), table)
    hit = {(d, t) for d, t, *_ in AWKWARD if contained([(d, t)], items)}
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(repr((r[0], r[1])) for r in AWKWARD if (r[0], r[1]) not in hit)
    assert kept.columns == frame(spark).columns
    assert decontaminate.find_items(frame(spark), table.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(frame(spark), table.limit(0)).count() == len(AWKWARD)


def test_more_items_than_a_block_take_more_passes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    items = [(i, " ".join(f"p{i}w{j}" for j in range(12 + i))) for i in range(7)]
    docs = [(i, " ".join(["x"] * 50 + t.split() + ["y"] * 30), None, None) for i, t in items]
    got = decontaminate.find_items(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(7)]


def test_items_whole_edited_and_scattered_are_found():
    rng = random.Random(5)
    for trial in range(150):
        item = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 200))]
        doc = [f"x{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 3000))]
        parts = [item] if trial % 3 else [item[: len(item) // 2 + 4], item[len(item) // 2 :]]
        for p in parts:
            at = rng.randint(0, len(doc))
            doc[at:at] = p
        index = decontaminate.ItemIndex([(0, " ".join(item).encode())], 5, 0.8, decontaminate.RECALL)
        assert bool(index.search(" ".join(doc).encode())) == bool(contained([(0, " ".join(doc))], [(0, " ".join(item))]))
