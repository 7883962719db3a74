"""Licence statements in texts: notice phrases and identifier tags by Aho-Corasick, expressions by a shunting yard.

One automaton runs over the lower-cased words of a text, joined by single blanks, and finds all phrases whose words
stand side by side; a second one runs over the lower-cased text and finds the tags that introduce an expression such as
``(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0``. Expressions are brought into postfix order
(WITH before AND before OR) and evaluated: a choice is as free as its freest part, a sum as its strictest, and an
exception lifts a licence to weak copyleft. No shuffle: every text is judged in the task that reads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import batches, rows, take_turn, text_bytes

#: Phrases and labels that every result has (fixed values).
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: How freely a text under a licence of a kind may be used again, from 0 (not at all) to 1.
FREEDOM = {"public": 1.0, "permissive": 0.9, "weak": 0.6, "strong": 0.4, "network": 0.3, "noncommercial": 0.2, "closed": 0.0, "other": 0.5}

#: Licence identifiers in lower case, without version suffixes, and their kind (fixed names of public licences).
IDENTIFIERS = {
    "0bsd": "public", "cc0": "public", "unlicense": "public", "wtfpl": "public", "pddl": "public",
    "afl": "permissive", "apache": "permissive", "artistic": "permissive", "bsd": "permissive", "bsl": "permissive", "cc-by": "permissive", "isc": "permissive", "mit": "permissive",
    "mit-0": "permissive", "ncsa": "permissive", "odc-by": "permissive", "postgresql": "permissive", "psf": "permissive", "python": "permissive", "zlib": "permissive",
    "cddl": "weak", "epl": "weak", "eupl": "weak", "lgpl": "weak", "mpl": "weak", "cc-by-sa": "weak", "odbl": "weak", "ofl": "weak",
    "gpl": "strong", "gfdl": "strong", "osl": "strong", "agpl": "network", "sspl": "network",
    "cc-by-nc": "noncommercial", "cc-by-nc-sa": "noncommercial", "cc-by-nc-nd": "noncommercial", "cc-by-nd": "noncommercial",
    "proprietary": "closed",
}
#: Notice phrases (words as the texts are cut) and their labels.
NOTICES = {
    "mit lizenz": "mit", "licence mit": "mit", "licencia mit": "mit", "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache lizenz": "apache", "licence apache": "apache", "licencia apache": "apache", "apache license version 2 0": "apache-2.0", "apache license 2 0": "apache-2.0",
    "general public license version 2": "gpl-2.0", "general public license version 3": "gpl-3.0", "licence publique générale": "gpl", "licencia pública general": "gpl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "european union public licence": "eupl", "boost software license": "bsl", "bsd license": "bsd", "bsd lizenz": "bsd", "licence bsd": "bsd", "licencia bsd": "bsd",
    "redistribution and use in source and binary forms": "bsd", "isc license": "isc", "zlib license": "zlib", "artistic license": "artistic",
    "released into the public domain": "unlicense", "dedicated to the public domain": "cc0", "cc0 1 0": "cc0", "open font license": "ofl", "free documentation license": "gfdl",
    "all rights reserved": "proprietary", "alle rechte vorbehalten": "proprietary", "tous droits réservés": "proprietary", "todos los derechos reservados": "proprietary",
}
#: Variants of the Creative Commons attribution licence; each is written short with a version, or in words.
CC_VARIANTS = {"": "", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives", "nc sa": "noncommercial sharealike", "nc nd": "noncommercial noderivatives"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
TAGS = ("spdx-license-identifier:", "license-expression:", "licence-expression:")

_TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9.+:-]+)")
_VERSION = re.compile(r"-v?\d[\d.]*(-only|-or-later|-clause.*|-\d.*)?\+?$|\+$")
_BINDS = {"with": 3, "and": 2, "or": 1}
#: Hides words, not their bounds.
_HIDE = bytes(122 if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 else c for c in range(256))
#: Cuts a text into words: A-Z become a-z, bytes that stand in no word become blanks.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def notices() -> dict[str, str]:
    """All phrases with their labels."""
    short = {f"cc by {v} {n}".replace("  ", " "): v for v in CC_VARIANTS for n in CC_VERSIONS}
    long = {f"creative commons attribution {words}".strip(): v for v, words in CC_VARIANTS.items()}
    creative = {phrase: "-".join(["cc", "by", *v.split()]) for phrase, v in (short | long).items()}
    return BASE_PHRASES | NOTICES | creative


def family(identifier: str) -> str:
    """The identifier in lower case without version and clause suffixes: ``GPL-3.0-or-later`` is ``gpl``."""
    name = identifier.lower()
    return name if name in IDENTIFIERS else _VERSION.sub("", name)


def freedom(label: str) -> float:
    return FREEDOM[IDENTIFIERS.get(family(label), "other")]


def postfix(tokens: list[str]) -> tuple[list[str], bool]:
    """The longest start of the tokens that reads as an expression, operands before operators; and whether it is whole.

    It ends before the first token that cannot follow. A bracket that stays open, an operator without a right side or
    an empty expression make it a broken one.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = False  # whether an operand has just ended
    for token in tokens:
        if token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            if not operand or "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif token in _BINDS:
            if not operand:
                break
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = False
        else:
            if operand:
                break
            out.append(token)
            operand = True
    whole = operand and "(" not in stack
    return out + [t for t in reversed(stack) if t != "("] if whole else out, whole


def evaluate(order: list[str]) -> tuple[float, str]:
    """Freedom of an expression in postfix order, and the expression written with all its brackets."""
    stack: list[tuple[float, str]] = []
    for token in order:
        if token not in _BINDS:
            stack.append((freedom(token), token))
            continue
        (right, right_text), (left, left_text) = stack.pop(), stack.pop()
        value = max(left, right) if token == "or" else min(left, right) if token == "and" else max(left, FREEDOM["weak"])
        stack.append((value, f"({left_text} {token} {right_text})"))
    return stack[0]


def licences_of(order: list[str]) -> set[str]:
    """Identifiers of a postfix expression that are licences: what follows WITH is an exception."""
    exceptions: set[int] = set()
    stack: list[tuple[int, ...]] = []
    for i, token in enumerate(order):
        if token in _BINDS:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                exceptions.update(right)
            stack.append(left + right)
        else:
            stack.append((i,))
    return {t for i, t in enumerate(order) if t not in _BINDS and i not in exceptions}


class Scanner:
    """The two automata; one per worker and call."""

    def __init__(self):
        self.notices, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase, label in notices().items():
            key = f" {phrase} ".encode().decode("latin-1")
            self.notices.add_word(key, (len(key), phrase.count(" ") + 1, label, phrase in BASE_PHRASES))
        for tag in TAGS:
            self.tags.add_word(tag, len(tag))
        self.notices.make_automaton()
        self.tags.make_automaton()

    def places(self, line: bytes) -> list[tuple[int, int, str, bool]]:
        """(word, number of words, label, base) of every phrase in words joined by blanks, a blank at both ends."""
        found = [(end + 1 - size, n, label, base) for end, (size, n, label, base) in self.notices.iter(line.decode("latin-1"))]
        if not found:
            return []
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        at = np.searchsorted(blanks, [f[0] for f in found])
        return [(int(w), *f[1:]) for w, f in zip(at, found)]

    def expressions(self, lower: bytes) -> Iterator[tuple[int, int, list[str], bool]]:
        """Start, end, postfix order and wholeness of the expression behind every tag, on the tag's line."""
        behind = 0
        for end, _ in self.tags.iter(lower.decode("latin-1")):
            if end < behind:
                continue
            tokens: list[str] = []
            at = end + 1
            while found := _TOKEN.match(lower, at):
                tokens.append(found[1].decode())
                at = found.end()
            behind = at
            yield end + 1, at, *postfix(tokens)

    def judge(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, places of one text."""
        words = text.translate(_TO_WORDS).split()
        places = self.places(b" " + b" ".join(words) + b" ")
        base = [p for p in places if p[3]]
        tagged = list(self.expressions(text.lower()))
        if tagged and places:  # what stands in an expression is no notice of its own
            shown = bytearray(text)
            for start, end, *_ in tagged:
                shown[start:end] = text[start:end].translate(_HIDE)
            places = self.places(b" " + b" ".join(shown.translate(_TO_WORDS).split()) + b" ")
        # of phrases that lie inside one another the outer one says what holds
        outer, reach = [], -1
        for word, n, label, _ in sorted(places, key=lambda p: (p[0], -p[1])):
            if word + n > reach:
                outer.append((word, n, label))
                reach = word + n
        labels = {label for _, _, label in outer} | {label for *_, label, _ in base}
        values = [freedom(label) for _, _, label in outer]
        written = []
        for _, _, order, whole in tagged:
            if not order:
                continue
            if whole:
                value, said = evaluate(order)
                labels |= licences_of(order)
                values.append(value)
                written.append(said)
            else:  # what a broken expression names holds all together
                named = [t for t in order if t not in _BINDS]
                labels.update(named)
                values.append(min(map(freedom, named)))
        starts = [p[0] for p in base]
        return (
            len(words),
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted({p[2] for p in base})),
            ",".join(sorted(labels)),
            min(values, default=0.0),
            written,
            [{"word": w, "n_words": n, "label": label} for w, n, label in outer],
        )


def find_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``, ``expressions``, ``places``.

    Words are runs of ``[0-9a-z]`` and of characters above ASCII in the lower-cased (A-Z) text. ``n_base`` counts all
    places of the base phrases, overlaps included; ``first_word`` and ``last_word`` are the smallest and largest word
    they begin at, null if there is none. ``labels`` has the base labels and those of other notices and of tagged
    expressions, both sorted, each once, joined by commas. ``places`` are the notices that lie in no longer one and in no expression.
    ``score`` is how freely the text may be used again: statements hold together, so the strictest counts; 0 if there
    is none, since nothing is granted then. A null or empty text has no words; texts are judged whole at any
    length; repeated rows give repeated results; an empty table gives no rows. Of phrases that begin at one word the
    longest counts.
    """
    slim = docs.select(F.col(id_col).alias(id_col), text_bytes(text_col).alias("_text"))
    place = T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("label", T.StringType())]))
    fields = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()), ("base_labels", T.StringType())]
    fields += [("labels", T.StringType()), ("score", T.DoubleType()), ("expressions", T.ArrayType(T.StringType())), ("places", place)]
    schema = T.StructType([slim.schema[id_col], *[T.StructField(n, t) for n, t in fields]])
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
    kinds.append(pa.list_(pa.struct([("word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string())])))

    def run(found):
        take_turn()
        scanner = Scanner()
        out = None

        for batch in found:
            if out is None:
                out = pa.schema([batch.schema.field(id_col), *[pa.field(n, k) for (n, _), k in zip(fields, kinds)]])
            yield from batches(((key, *scanner.judge(text)) for key, text in rows(batch, id_col, "_text")), out)

    return slim.mapInArrow(run, schema)
