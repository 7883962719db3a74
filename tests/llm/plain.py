"""Plain versions of the operators, for small inputs, and a table of awkward documents."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0D]+")

SENTENCE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from old trees near the river bank"
LONG = " ".join(f"word{i % 977}x{i * i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(48))

#: doc_id, text and columns whose names the operators use inside.
AWKWARD = [
    (1, SENTENCE, "a", 1),
    (1, SENTENCE, "a", 1),
    (2, SENTENCE, "b", None),
    (3, SENTENCE.replace("seven", "eight") + " again and again until the sun went down behind the far blue hills of home", None, 3),
    (4, None, None, None),
    (5, "", "x", 5),
    (6, " \n\t  \n ", "x", 6),
    (None, f"before {PASSAGE} after", "n", 7),
    (8, f"one two {PASSAGE} three\nfour  {PASSAGE}", "n", 8),
    (9, LONG, "long", 9),
    (10, "ok", "short", 10),
    (11, "ok", "short", 10),
    (12, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "run", 1),
    (13, "naïve café 漢字かな 🙂 ok\x85x y z\x1cq 'tis we'll 12345 <|endoftext|>", "uni", 2),
    (14, "line one is here\nline one is here\n\n  \nother ### $$$ <b>&amp;</b> | x", "dup", 3),
]
COLUMNS = "doc_id long, text string, node string, shard int"


def frame(spark, rows=AWKWARD, columns=COLUMNS):
    """The rows with more columns of clashing names."""
    from pyspark.sql import functions as F

    clash = ["_raw", "_id", "doc", "key", "part", "size", "score", "kept", "_th", "words", "item_id", "_row", "_blank", "_class", "_node", "_doc", "_text_node", "_text", "_lang", "name", "check", "wanted"]
    return spark.createDataFrame(rows, columns).withColumns({c: F.lit("clash") for c in clash})


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    w = words(text)
    k = min(k, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def sha(value: bytes | str) -> str:
    return hashlib.sha256(value.encode() if isinstance(value, str) else value).hexdigest()


def without_repeats(texts, window):
    """n_words, n_removed and what is left for every text."""
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def classes(rows, threshold=0.8):
    """For (id, text) rows: least id of the class, links, links to other texts; wordless texts stand alone."""
    sets = [shingles(t) for _, t in rows]
    near = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and (rows[i][1] == rows[j][1] or len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])):
                near[i].add(j)
                near[j].add(i)
    group = list(range(len(rows)))
    for _ in rows:
        for i in near:
            for j in near[i]:
                group[i] = group[j] = min(group[i], group[j])
    out = []
    for i, (key, text) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((key, min(ids) if ids else None, len(near[i]), len({rows[j][1] for j in near[i]} - {text})))
    return out
