import random

import corpus_pipeline
from pageloom.llm import pii_crf, toxicity
from pageloom.llm.queries import QUERIES
from tests.llm.plain import classes, shingles
from tests.llm.test_similarity import edited


def write(frame, folder, name):
    frame.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_stages_against_a_plain_version(spark, tmp_path):
    rng = random.Random(3)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))

    items = [(i, prose(20)) for i in range(3)]
    rows = [(i, prose(rng.randint(20, 90)) + (" zorple vexxid quimbo" if i % 5 == 0 else ""), i % 5 == 0) for i in range(300)]
    rows += [(300 + i, rows[i][1] if i % 2 else edited(rng, rows[i][1], 1), rows[i][2]) for i in range(40)]
    rows += [(400 + i, prose(10) + " " + items[i][1] + " " + prose(10), False) for i in range(3)]
    rows += [(500, prose(30) + " call +1 (212) 555-0187", False), (501, None, False), (502, "", False), (None, prose(30), False)]
    folder = str(tmp_path)
    docs = spark.createDataFrame([(d, t, "en", "s", len(t) if t is not None else None) for d, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    write(docs, folder, "documents")
    write(spark.createDataFrame([(d, int(y)) for d, _, y in rows if d is not None], "doc_id long, toxic int"), folder, "labels")
    write(spark.createDataFrame(items, "item_id long, text string"), folder, "benchmark")

    held, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, folder)
        if name != "byte_bpe":
            assert held.columns == docs.columns
        held.write.parquet(f"{folder}/{name}")
        held = spark.read.parquet(f"{folder}/{name}")
        seen[name] = held.collect()

    kept = [(r.doc_id, r.text) for r in seen["toxicity"]]
    truly = {d for d, _, y in rows if y}
    assert len({d for d, _ in kept} & truly) <= 0.1 * len(truly)
    assert len(kept) >= 0.97 * (len(rows) - len(truly))
    one = [(d, t) for (d, t), (_, least, *_) in zip(kept, classes(kept)) if d == least or not shingles(t)]
    assert sorted(map(repr, one)) == sorted(repr((r.doc_id, r.text)) for r in seen["near_duplicates"])
    leaks = {d for d, t in one for _, item in items if len(shingles(item) & shingles(t)) >= 0.8 * len(shingles(item))}
    clean = [(d, t) for d, t in one if d not in leaks]
    assert sorted(map(repr, clean)) == sorted(repr((r.doc_id, r.text)) for r in seen["decontamination"])
    masks = {d: t if t is None else pii_crf.masked(t, pii_crf.all_spans([t])[0][1]) for d, t in clean}
    assert {r.doc_id: r.text for r in seen["personal_data"]} == masks and masks[500].endswith("call <phone>")
    from pageloom.llm.byte_bpe import codec
    import public_tokenizers

    own = codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert {r.doc_id: own.bpe.decode(r.ids).decode() for r in seen["byte_bpe"]} == {d: t or "" for d, t in masks.items()}
    assert all(r.n_tokens == len(r.ids) for r in seen["byte_bpe"])


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert toxicity.DECISION == 0.7
