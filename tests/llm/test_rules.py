import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import pii_crf, quality, sharding, toxicity, url_filter
from tests.llm.plain import AWKWARD, frame, words


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def plain_counts(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), n < 10 or 100 * len(hit) > 20 * n


def test_counts_of_awkward_rows(spark):
    ratios = quality.fit(frame(spark), frame(spark).where("doc_id in (2, 3)"))
    got = quality.assess(frame(spark), ratios).collect()
    assert by_id(tuple(r)[:7] for r in got) == by_id((r[0], *plain_counts(r[1])) for r in AWKWARD)
    assert all(r.kept == (not r.base_failed and r.score >= quality.THRESHOLD) for r in got)
    assert quality.assess(frame(spark).limit(0), ratios).count() == 0


def test_ratios_follow_the_two_multinomials(spark):
    rows = [(1, "good good fine"), (2, "bad bad bad"), (None, "bad good"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    ratios = quality.fit(docs, trusted)
    key = {r.w: r.b for r in spark.createDataFrame([("good",), ("bad",), ("fine",)], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(quality.BUCKETS)).alias("b")).collect()}
    total = quality.BUCKETS
    for word, raw, target in (("good", 3, 2), ("bad", 4, 0), ("fine", 1, 1)):
        want = math.log((1 + target) / (total + 5)) - math.log((1 + raw) / (total + 13))
        assert ratios.values[key[word]] == pytest.approx(want)
    assert set(quality.fit(docs, trusted.limit(0)).values) == {0.0}
    assert set(quality.fit(docs.limit(0), trusted).values) == {0.0}


def test_a_score_is_the_mean_log_ratio(spark):
    values = [math.sin(i) for i in range(quality.BUCKETS)]
    docs = spark.createDataFrame([(1, "x y x y z"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.assess(docs, quality.Ratios(tuple(values))).collect()}
    hashes = [r.h for r in spark.createDataFrame([(i, w) for i, w in enumerate("xyxyz")], "i int, w string").orderBy("i").select(F.xxhash64("w").alias("h")).collect()]
    pairs = [r.h for r in spark.createDataFrame([(i, *p) for i, p in enumerate(zip(hashes, hashes[1:]))], "i int, a long, b long").select(F.xxhash64("a", "b").alias("h")).collect()]
    want = sum(values[h % quality.BUCKETS] for h in hashes + pairs) / (9 + quality.PRIOR)
    assert got[1] == pytest.approx(want, abs=1e-5)
    assert got[2] == 0


URLS = [
    ("https://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/"),
    ("HTTP://EXAMPLE.ORG/en/12?q", "example.org", "/en/12", "example.org/en/1"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/"),
    ("https://x.com/fr/a", "x.com", "/fr/a", "com/fr/"),
    ("https://com/de/", "com", "/de/", "com/de/"),
    ("https://x.com/fr", "x.com", "/fr", None),
    ("https://x.org", "x.org", "", None),
    ("https://x.org?a=/b", "x.org", "", None),
    ("https://x.net#f://y/z", "x.net", "", None),
    ("ftp://u@Ä.NET:8/a://b#c", "u@Ä.net:8", "/a://b", None),
    ("://h/p", "h", "/p", None),
    ("no scheme", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
    ("x\ny://Ho\nst/p\nq?r", "ho\nst", "/p\nq", None),
]


def test_hosts_paths_and_rules(spark):
    model = url_filter.fit(url_filter.labelled(spark))
    pages = spark.createDataFrame([(i, u, "c", 1) for i, (u, *_) in enumerate(URLS)], "page_id long, url string, host string, logit int")
    got = url_filter.judge(pages, model).orderBy("page_id").collect()
    kinds = {entry: kind for kind, entry in url_filter.RULES}
    for r, (_, host, path, rule) in zip(got, URLS):
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (kinds[rule] if rule else "block" if r.logit > 0 else "allow")
    assert url_filter.judge(pages.limit(0), model).count() == 0


def test_the_model_knows_its_table_and_hosts_like_it(spark):
    model = url_filter.fit(url_filter.labelled(spark))
    known = [(f"https://{u}", 1) for u in url_filter.BLOCKED] + [(f"https://{u}", 0) for u in url_filter.ALLOWED]
    new = [("https://cheap-pills.shop.example.net/x", 1), ("http://m.casino-win.example.com/en/4033.html", 1), ("https://blog.stthon.example.com/en/5", 0)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(known + new)], "page_id long, url string")
    got = {r.page_id: r.logit > 0 for r in url_filter.judge(pages, model, rules=()).collect()}
    assert [got[i] for i in range(len(known + new))] == [y == 1 for _, y in known + new]


def test_shards_of_awkward_rows(spark):
    got = sharding.byte_shards(frame(spark)).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert by_id((r.doc_id, r["size"], r.text_crc32) for r in got) == by_id((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in AWKWARD)
    check_places(got, sum(size(r[1]) for r in AWKWARD))
    assert sharding.byte_shards(frame(spark).limit(0)).count() == 0


def check_places(got, total):
    placed = defaultdict(list)
    for r in got:
        placed[r.shard].append((r.slot, r.doc_id if r.doc_id is not None else -1, r["size"]))
    last, before = None, 0
    for shard in sorted(placed):
        rows = sorted(placed[shard])
        assert [s for s, _, _ in rows] == list(range(len(rows)))
        ids = [d for _, d, _ in rows]
        assert ids == sorted(ids) and (last is None or last <= ids[0])
        for _, _, n in rows:
            assert min(7, (2 * before + n) * 8 // (2 * total)) == shard
            before += n
        last = ids[-1]


def test_shards_are_balanced_with_equal_ids(spark):
    rng = random.Random(3)
    rows = [(rng.choice([5, i]), "x" * rng.randint(0, 300), None, None) for i in range(600)]
    got = sharding.byte_shards(frame(spark, rows)).collect()
    total = sum(len(r[1]) + 1 for r in rows)
    check_places(got, total)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert all(abs(sizes[k] - total / 8) <= 301 for k in range(8))


def test_base_spans_equal_the_plain_patterns():
    import re

    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def passes(kind, text):
        digits = "".join(c for c in text if c in "0123456789")
        if kind == "ip":
            return all(int(p) <= 255 for p in text.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and pii_crf.luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    rng = random.Random(11)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@+ -(%2b9.@é4") for _ in range(rng.randint(0, 45)))
        want = [(k, *m.span()) for k, p in plain.items() for m in re.finditer(p, text) if passes(k, m.group())]
        assert pii_crf._ordered(pii_crf.base_spans(text)) == want


def test_long_texts_without_blanks_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 100_000, "1." * 100_000, "+1" * 100_000):
        pii_crf.base_spans(text)


def plain_viterbi(scores, move):
    best, paths = scores[0], [[k] for k in range(len(move))]
    for row in scores[1:]:
        across = best[:, None] + move
        paths = [[*paths[int(across[:, k].argmax())], k] for k in range(len(move))]
        best = across.max(axis=0) + row
    return paths[int(best.argmax())]


def test_batches_decode_as_single_sequences():
    rng = np.random.default_rng(2)
    field, k = pii_crf.field(), len(pii_crf.LABELS)
    sequences = [rng.normal(0, 3, (n, k)) for n in (1, 7, 3, 30, 1, 12, 0)]
    got = field.decode(sequences)
    for s, path in zip(sequences, got):
        assert path.tolist() == (plain_viterbi(s, field.move) if len(s) else [])


def test_the_field_reads_new_lines_and_leaves_plain_numbers():
    found = lambda t: [t[a:b] for _, a, b in pii_crf.all_spans([t])[0][1]]
    assert found("ring me (555) 555-0123 or later") == ["(555) 555-0123"]
    assert found("a 212-555-0143 b") == ["212-555-0143"]
    assert found("write bob@corp.example.org now") == ["bob@corp.example.org"]
    for plain in ("in 1998-2003 he had 12 cats", "Version 3.1 of 2011", "rooms 7, 8 and 9", 'token = "ede43f42c939b6405768150e0411590525cf889e"', "no digits here"):
        assert found(plain) == []


def test_spans_of_awkward_rows_and_masks(spark):
    rows = [*AWKWARD, (20, "é to x@y.org or +1 (212) 555-0187, 4111 1111 1111 1111 at 10.0.0.1 (030) 5550 1234", "p", 1)]
    got = {r.doc_id: r for r in pii_crf.find_spans(frame(spark, rows)).collect()}
    assert (got[20].n_email, got[20].n_ip, got[20].n_card, got[20].n_phone) == (1, 1, 1, 1)
    assert got[20].spans.startswith("email:5:12,ip:") and got[4].spans == got[5].spans == ""
    assert pii_crf.find_spans(frame(spark).limit(0)).count() == 0
    masks = {r.doc_id: r.text for r in pii_crf.mask(frame(spark, rows)).collect()}
    assert masks[20] == "é to <email> or <phone>, <card> at <ip> <phone>" and masks[4] is None and masks[9] == AWKWARD[9][1]
    with_length = pii_crf.mask(frame(spark, rows).withColumn("n_chars", F.lit(99).cast("long")))
    assert {r.doc_id: r.n_chars for r in with_length.collect()}[20] == len(masks[20])


def corpus(n, seed):
    """Texts in two invented languages; toxic ones hold one of a few words, or of a family with a common beginning."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        common = ["the of and to in", "der die und das den"][i % 2].split()
        w = [rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(2, 4) * toxic):
            w[rng.randrange(len(w))] = rng.choice(["zorple", "vexxid", "quimbo"]) if i % 2 == 0 else f"grunz{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}"
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_held_out_accuracy(spark):
    rows = corpus(1500, 1)
    docs = spark.createDataFrame([(i, t, "l", 1) for i, t, _ in rows], "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    network = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    got = {r.doc_id: r for r in toxicity.score(docs, network).collect()}
    aside = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {r.doc_id for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()} == {i for i, _ in aside}
    right = np.mean([got[i].predicted == y for i, y in aside])
    caught = np.mean([got[i].predicted for i, y in aside if y])
    assert right > 0.95 and caught > 0.85
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, network).collect()}
    assert kept == {i for i in got if got[i].predicted == 0}
    awkward = toxicity.score(frame(spark), network).collect()
    assert len(awkward) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in awkward)
    assert len({r.score for r in awkward if r.doc_id in (4, 5, 6)}) == 1
    assert toxicity.score(frame(spark).limit(0), network).count() == 0


def test_few_labels_reject_no_document(spark):
    """Three toxic labels and a clean one fit no network; their share alone must not decide."""
    docs = frame(spark, [(i, f"text number {i}", None, None) for i in range(6)] + [(6, "", None, None), (7, None, None, None)])
    network = toxicity.fit(docs, spark.createDataFrame([(0, 1), (1, 1), (2, 1), (3, 0)], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(docs, network).collect()} == {0}
    assert toxicity.drop_toxic(docs, network).count() == 8


def test_one_class_alone_gives_its_share(spark):
    docs = frame(spark)
    for label, want in ((0, 0.0), (1, 0.0)):
        labels = spark.createDataFrame([(2, label), (3, label)], "doc_id long, toxic int")
        assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {want}


def test_parts_of_a_long_text_score_alike(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [toxicity.words_of(t) for _, t, _ in corpus(80, 2)]
    network = toxicity.train(texts, np.array([y for _, _, y in corpus(80, 2)]))
    text = " ".join(rng.choice([w for t in texts for w in t], 120_000))
    whole = network.logit(np.concatenate([network.project(toxicity.words_of(text)[a : a + 1000]) for a in range(0, 120_000, 1000)]))
    assert toxicity.Scorer(network).score(text) == pytest.approx(network.score(whole, toxicity.language(toxicity.words_of(text))), abs=1e-4)


def test_the_fit_goes_through_its_texts_once():
    """Words of all texts at once took most of the driver's memory; texts may come one by one."""
    rows = corpus(120, 5)
    texts, y = [toxicity.words_of(t) for _, t, _ in rows], np.array([y for _, _, y in rows])
    one = toxicity.calibrate(toxicity.train(texts, y), texts, y)
    other = toxicity.calibrate(toxicity.train(iter(texts), y), iter(texts), y)
    assert (one.embedding == other.embedding).all() and (one.thresholds == other.thresholds).all() and (one.scales == other.scales).all()


def test_all_labelled_texts_are_learned_from_whole(spark, monkeypatch):
    """Toxic words at the end of long texts, more shards than one, no text left out."""
    rows = corpus(240, 5)
    long = [(1000 + i, "plain words of no kind " * 3000 + "vexquor brambit", 1) for i in range(12)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows + long], "doc_id long, text string")
    only_long = spark.createDataFrame([(i, y) for i, _, y in rows if not y] + [(i, 1) for i, _, _ in long], "doc_id long, toxic int")
    network = toxicity.fit(docs, only_long)
    assert network.constant is None
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, network).collect()}
    assert all(found[i] for i, _, _ in long) and not any(found[i] for i, _, y in rows if not y)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    counted = []
    monkeypatch.setattr(toxicity, "_added_up", lambda df, own=toxicity._added_up: counted.append(own(df)) or counted[-1])
    one = toxicity.fit(docs, labels)
    # all texts of all shards are counted, and the mean of the shards tells them apart as one shard does
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 8_000)
    several = toxicity.fit(docs, labels)
    first = [sums for _, sums in counted if len(sums) == 4 + 2 * (toxicity.BUCKETS + 1)]
    assert counted[0][0] == 1 and counted[len(counted) // 2][0] > 1
    assert [s[:4].sum() for s in first] == [240, 240] and first[0][[0, 2]].sum() == first[1][[0, 2]].sum()
    for network in (one, several):
        found = {r.doc_id: r.predicted for r in toxicity.score(docs, network).collect()}
        assert sum(found[i] == y for i, _, y in rows) >= 0.95 * len(rows)


def test_one_shard_is_learned_as_train_does(spark):
    rows = corpus(120, 6)
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    draw = {r.doc_id: r.d for r in docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("d")).collect()}
    rows.sort(key=lambda r: (draw[r[0]], r[1].encode()))
    texts, y, aside = [toxicity.words_of(t) for _, t, _ in rows], np.array([y for _, _, y in rows]), np.arange(len(rows)) % 4 == 3
    plain = toxicity.calibrate(toxicity.train([t for t, a in zip(texts, aside) if not a], y[~aside]), [t for t, a in zip(texts, aside) if a], y[aside])
    fitted = toxicity.fit(docs, labels)
    for name in ("embedding", "filters", "bias", "out", "shift", "thresholds", "scales"):
        assert np.allclose(getattr(plain, name), getattr(fitted, name), atol=1e-5)
