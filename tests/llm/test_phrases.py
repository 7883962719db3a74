"""Licence scan, collocations and the conversation trie on small tables against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pageloom.llm import collocations, licences, prefix_trie
from tests.llm.plain import AWKWARD, frame

LICENCE_TEXTS = [
    "Released under the MIT License. mit licensed? MIT-license! mit  license",
    "the mit mit license and GNU Lesser General Public License",
    "Licensed under CC BY-NC-SA 4.0, not CC BY 4.0.",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */",
    "SPDX-License-Identifier: MIT OR\nnext line SPDX-License-Identifier: ) and",
    "spdx-license-identifier:",
    "license-expression: GPL-3.0-or-later OR (MIT AND CC-BY-NC-4.0)",
    "mit license" * 3 + " mit\x85license mit license apache.license ümit license",
    None,
    "",
    " ".join(["general public license"] * 5000),
]


def plain_base(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for phrase, label in licences.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + phrase.count(" ") + 1] == phrase.split()]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in at}))


def test_licence_base_columns(spark):
    texts = LICENCE_TEXTS + [r[1] for r in AWKWARD]
    got = licences.find_licences(frame(spark, [(i, t, "n", 1) for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [tuple(r)[1:6] for r in got] == [plain_base(t) for t in texts]
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert got[2].labels == "cc-by,cc-by-nc-sa" and got[2].score == licences.FREEDOM["noncommercial"]
    assert got[1].labels == "gpl,lgpl,mit"
    assert got[3].expressions == ["((mit or apache-2.0) and (gpl-2.0-only with classpath-exception-2.0))"]
    assert got[3].labels == "apache-2.0,gpl-2.0-only,mit" and got[3].score == licences.FREEDOM["weak"]
    assert got[4].expressions == [] and got[4].labels == "mit" and got[5].labels == ""
    assert got[6].score == licences.FREEDOM["strong"]


def test_licences_of_nothing(spark):
    assert licences.find_licences(frame(spark).limit(0)).count() == 0


def plain_value(tokens):
    """Freedom of a well-formed expression by Python's own parser; WITH binds tightest, then AND, then OR."""
    said = " ".join({"with": "@", "and": "*", "or": "+"}.get(t, t if t in "()" else f"V({t!r})") for t in tokens)

    class V:
        def __init__(self, x):
            self.x = licences.freedom(x) if isinstance(x, str) else x

        __mul__ = lambda a, b: V(min(a.x, b.x))
        __add__ = lambda a, b: V(max(a.x, b.x))

    # Python has no operator above * but **, which is right-associative: chains of WITH are not made here
    V.__pow__ = lambda a, b: V(max(a.x, licences.FREEDOM["weak"]))
    return eval(said.replace("@", "**"), {"V": V}).x


def test_expressions_against_python(spark):
    draw = random.Random(5)

    def expression(depth):
        if depth == 0 or draw.random() < 0.3:
            name = [draw.choice(["mit", "gpl-2.0-only", "agpl-3.0", "cc-by-nc-4.0", "mpl-2.0", "licenseref-x"])]
            return name + ["with", "classpath-exception-2.0"] if draw.random() < 0.2 else name
        inner = expression(depth - 1) + [draw.choice(["and", "or"])] + expression(depth - 1)
        return ["(", *inner, ")"] if draw.random() < 0.5 else inner

    for _ in range(300):
        tokens = expression(4)
        order, whole = licences.postfix(tokens + ["*/", "prose"])
        assert whole and licences.evaluate(order)[0] == plain_value(tokens)


@pytest.mark.parametrize("tokens,whole", [([], False), (["("], False), (["mit", "and"], False), (["(", "mit"], False), (["mit", ")"], True), (["and"], False), (["mit", "or", "("], False), (["(", ")"], False)])
def test_broken_expressions(tokens, whole):
    assert licences.postfix(tokens)[1] is whole


# --- collocations -------------------------------------------------------------------------------------------------


def plain_counts(docs, longest=3):
    counts, totals = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, " ".join(words[i : i + n])] += 1
    return counts, totals


def plain_collocations(docs, least, first):
    counts, totals = plain_counts(docs)
    found = defaultdict(list)
    for (lang, phrase), a in counts.items():
        w = phrase.split(" ")
        if len(w) == 1 or a < least:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, " ".join(w[:k])], counts[lang, " ".join(w[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        longer = [b for (other, p), b in counts.items() if other == lang and p.count(" ") == 2 and len(w) == 2 and b >= least and f" {phrase} " in f" {p} "]
        if not any(100 * b >= 50 * a for b in longer):
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, phrase.encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for lang, rows in found.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:first]))


def some_docs():
    draw = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "délta", "x-y", "é", "İ", "of", "the", "the", "the"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", ";x", " ? ", " "]
    made = [("".join(draw.choice(words) + draw.choice(seps) for _ in range(draw.randrange(80))), draw.choice(["en", "de", None, "und"])) for _ in range(120)]
    return made + [(None, "en"), ("", None), ("...", "fr"), ("the of", "")] + [("the beta the beta of", "en")] * 15


def doc_frame(spark, docs):
    return spark.createDataFrame([(i if i % 7 else None, t, lang, "clash", 1, "c") for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string, name string, n int, phrase string")


@pytest.mark.parametrize("bits", [26, 8])
def test_collocations_against_plain(spark, bits):
    """A filter of 256 bits lets nearly all through; the result stays."""
    docs = some_docs()
    got = collocations.collocations(doc_frame(spark, docs).repartition(5), least=10, first=20, filter_bits=bits)
    assert sorted(map(tuple, got.collect())) == plain_collocations(docs, 10, 20)


def test_phrase_counts_of_long_texts(spark, monkeypatch):
    """Texts longer than a chunk are cut between words; nothing on the cut is lost or counted twice."""
    docs = [(" ".join(t for t, _ in some_docs() if t) * 3, "en"), ("verylongword" * 50 + " a  b" * 30 + " " * 500 + "c b " * 40, "en")]
    texts = doc_frame(spark, docs).select("text", "lang").collect()
    from pageloom.llm.collocations import _chunks
    import pyarrow as pa

    monkeypatch.setattr(collocations, "CHUNK_BYTES", 100)
    batch = pa.RecordBatch.from_pydict({"_text": [t.encode() for t, _ in docs], "_lang": [lang for _, lang in docs], "_id": [1, 2]})
    got, words = Counter(), 0
    for chunk, about in _chunks([batch], 3):
        words += len(chunk.start) - chunk.skip
        for n in (1, 2, 3):
            got.update(chunk.phrase(i, n).decode() for i in np.flatnonzero(chunk.valid(n)))
    counts, totals = plain_counts([(t, "x") for t, _ in docs])
    assert got == Counter({p: n for (_, p), n in counts.items()}) and words == totals["x"]


def test_equal_fingerprints_stay_apart(spark, monkeypatch):
    """With fingerprints of 3 bits nearly all phrases collide; the check against the text keeps their counts."""
    docs = [(t, lang) for t, lang in some_docs() if t]
    batch_rows = [(t.encode(), "und" if lang is None else lang, i) for i, (t, lang) in enumerate(docs)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"_text": [r[0] for r in batch_rows], "_lang": [r[1] for r in batch_rows], "_id": [r[2] for r in batch_rows]})
    whole = collocations.Chunk.fingerprints

    def small(self, powers, longest):
        prints = whole(self, powers, longest)
        return [p & np.uint64(7) for p in prints] if powers.base == collocations.BASE else prints

    monkeypatch.setattr(collocations.Chunk, "fingerprints", small)

    class Full:
        value = np.full(4, 2**64 - 1, np.uint64).tobytes()

    counted, pointers = {}, {}
    sent = [out for out in collocations._pointer_counter(3, 8, [Full, Full, Full], 6)([batch.slice(0, 50)])] + [out for out in collocations._pointer_counter(3, 8, [Full, Full, Full], 6)([batch.slice(50)])]
    gathered = pa.Table.from_batches(sent).sort_by("bucket").combine_chunks().to_batches()
    for out in collocations._summed(1, 6)(gathered):
        for row in out.to_pylist():
            if row["lang"] is None:
                key = row["m"], row["name"], row["check"]
                assert key not in counted
                counted[key], pointers[key] = row["n"], row["pointer"]
    assert len({name for _, name, _ in counted}) <= 8
    wanted = [[{"m": m, "name": n, "check": c, "a": counted[m, n, c]} for (m, n, c), at in pointers.items() if at == i and m > 1] for i in range(len(docs))]
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("m", "name", "check", "a")]))
    import zstandard

    texts = pa.array([zstandard.compress(r[0]) for r in batch_rows], pa.binary())
    pointed = pa.RecordBatch.from_arrays([texts, *batch.columns[1:], pa.array(wanted, kind)], names=[*batch.schema.names, "wanted"])
    got = {(r["lang"], r["phrase"]): r["a"] for out in collocations._cutter(3)([pointed]) for r in out.to_pylist()}
    assert got == {(lang, p): n for (lang, p), n in plain_counts(docs)[0].items() if " " in p}


def test_collocations_of_nothing(spark):
    assert collocations.collocations(doc_frame(spark, some_docs()).limit(0)).count() == 0
    assert collocations.collocations(doc_frame(spark, [(None, None), ("", "en"), ("a b", "en")])).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**12
    counted = spark.createDataFrame([(None, 1, 1, 1, 10**13, 0), (None, 1, 2, 2, big, 0), (None, 2, 3, 3, big - 1, 0), ("en", None, None, None, 10**15, None)], collocations.COUNTED)
    phrases = spark.createDataFrame([("en", 2, 3, 3, big - 1, "a b", [1, 1, 2, 2], [])], collocations.PHRASE)
    got = collocations.score_phrases(counted, phrases).collect()
    assert [(r.score, r.l, r.r) for r in got] == [(1000000 * (big - 1) ** 2 // (10**13 * big), 10**13, big)]


# --- conversation trie --------------------------------------------------------------------------------------------


def plain_trie(rows, family=100, most=5):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    said = {c: [t[3] for t in sorted(ts)] for c, ts in said.items()}
    built = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        donor = c - (c % family if c >= 0 else -(-c % family))
        built[c] = tuple(said.get(donor, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    own = {node: (len(ms) - 1) * len(node[-1][1]) if node else 0 for node, ms in members.items()}
    saved, leaves = Counter(), Counter()
    for node in members:
        for d in range(len(node) + 1):
            saved[node[:d]] += own[node]
            leaves[node[:d]] += not children[node]
    out = []
    for node, ms in members.items():
        here = ",".join(map(str, sorted(c for c in ms if built[c] == node)))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), children[node], leaves[node], saved[node], hashlib.sha256(here.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_turns():
    draw = random.Random(11)
    rows = []
    for c in [*range(95, 130), *range(200, 215), *range(-130, -95), 305, 777]:
        start = draw.choice(["hello", "hello", "hi", None])
        rows += [(c, t if t or draw.random() < 0.8 else None, draw.choice(["user", None]), start if t == 0 else draw.choice(["a", "bb", "ccc"])) for t in range(draw.randrange(1, 9))]
    rows += [(c, t, "user", f"same {t}") for c in range(400, 460) for t in range(6)]  # one conversation many times
    rows += [(501, 0, "user", "once")] * 3 + [(None, 0, "user", "lost"), (502, 3, "b", "tie"), (502, 3, "a", "tie"), (502, 3, None, None)]
    return rows


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "x") for r in rows], "conv_id long, turn long, role string, text string, place int, digest string, rep string")


@pytest.mark.parametrize("block", [4096, 2])
def test_trie_against_plain(spark, monkeypatch, block):
    """Also with blocks of two turns, as if every conversation and every list of ends were very long."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = some_turns()
    got = prefix_trie.conversation_trie(turn_frame(spark, rows).repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


def test_trie_of_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    rows = [(7, t, "user", f"turn {t % 5}") for t in range(900)] + [(c, 0, "user", "turn 0") for c in range(8, 20)]
    got = prefix_trie.conversation_trie(turn_frame(spark, rows).repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(turn_frame(spark, some_turns()).limit(0)).count() == 0
    lost = prefix_trie.conversation_trie(turn_frame(spark, [(None, 0, "user", "lost")]))
    assert lost.count() == 0
