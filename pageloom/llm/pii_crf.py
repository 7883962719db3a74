"""Personal data: fixed patterns with checks, and a linear-chain conditional random field over token shapes.

The field is trained in numpy from the small labelled table below and decoded by Viterbi in batches of stretches of
all texts at once. It adds spans that the patterns miss, such as telephone numbers without a country code.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import batches, rows, take_turn, text_bytes

KINDS = ("email", "ip", "card", "phone")

#: Characters before the @ of an address, and patterns of the base; fixed values of the contract.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive runs and the look-behind change no match, they only keep long runs of digits linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[Span]:
    """Each @ with the run of address characters before it; no run is read twice."""
    free, before, at = 0, 0, text.find("@")
    while at >= 0:
        run = text[max(free, before) : at]
        start = max(free, before) + len(run.rstrip(LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            free = found.end()
        before = at + 1
        at = text.find("@", max(before, free))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and apart within a kind; matches that fail their check are dropped."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 4 else int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return found


#: Labelled lines: [kind text] marks a span, all else is plain.
LABELLED = """
call [phone (212) 555-0187] after nine
Tel. [phone 212-555-0143], ask for Ann
phone: [phone (030) 5550 1234]
fax [phone 415.555.0199] or write
mobile [phone 0171 555 01 88] please
my number is [phone (017) 555-7713].
reach us under [phone +49 30 555 01 23] today
dial [phone 1-800-555-0100] for help
a [phone 415-555-0100] b
de [phone 646-555-0177] la
be [phone (702) 555-0165] ed
fed [phone 305-555-0119] a
add [ip 198.51.100.4] de
a 12 b 34 cd 56
the office ([phone (800) 555-0155]) is open
[phone (427) 555-5262]
[phone +1 (427) 555-5262]
and the [phone (131) 555-7634] erend thing
an [phone (289) 555-1177] ther, en
mail [email ann.lee@mail3.example.com] now
write to [email j_doe@example.org], thanks
[email x@mail.example.net]
contact: [email info+list@shop.example.com].
from [email ann@localhost] to root
to [email bob.84@intranet] by noon
send it to <[email k.may@post.example.com]>
host [ip 10.0.0.7] is down
server [ip 192.168.1.254]:8080 answers
ping [ip 203.0.113.9] failed
address [ip 2001:db8:0:0:0:0:0:1] assigned
from [ip fe80:0:0:1:a1b2:3c4d:5e6f:7081] again
card [card 4111 1111 1111 1111] expired
pay with [card 5500-0000-0000-0004] only
visa [card 4012.8888.8888.1881], thanks
[card 4222222222222220] was charged
number [card 3782.822463.10005] on file
in 2024 and 1999 we met
from 2019-2021 it rained
on 2024-01-15 at 12:30
at 09:45 on 3.12.2020
costs 1,299.50 or 15 percent
Version 2.0 of the License
Apache License, Version 2.0.
Licensed under CC BY-NC 4.0.
see section 3.2.1 on page 45
chapter 12, verse 7
token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
key = "a85f09bb21c4de77" in file 7
order 4411 of 12 items
id 000123456789 was closed
it has 1000000 rows and 17 columns
between 10 and 20 or 30 and 40
rooms 101, 102 and 103
population 8 336 817 in 2016
ISBN 978-3-16-148410-0 in print
3.14159 is near pi
the ratio 16:9 or 4:3
release 10.15.7 of the system
follow @anna on the net
prices @ 5 each
a@b is not enough @ all
score 3-2 after 90 minutes
highway 66, exit 12b
""".strip().split("\n")

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\x20\x09-\x0D]")
_TRIGGER = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"\[(email|ip|card|phone) ([^\]]*)\]")
LABELS = ("O",) + tuple(f"{p}-{k}" for k in KINDS for p in ("B", "I"))
#: Plain words on each side of a stretch that the field sees as context.
CONTEXT = 2


def shape(token: str) -> str:
    """Letters by case, digits by number of them, other characters as they are."""
    if token[0] in "0123456789":
        n = len(token)
        return f"9{n}" if n <= 4 else "9s" if n <= 8 else "9m" if n <= 12 else "9l"
    if token.isalpha():
        return "hex" if len(token) <= 4 and all(c in "abcdefABCDEF" for c in token) else "A" if token.isupper() else "Aa" if token[0].isupper() else "a"
    return token


def _features(tokens: list[tuple[int, int, str]]) -> list[list[str]]:
    shapes = ["<", "<"] + [shape(t) for _, _, t in tokens] + [">", ">"]
    gaps = [True] + [a[1] != b[0] for a, b in zip(tokens, tokens[1:])] + [True]
    out = []
    for i, (_, _, token) in enumerate(tokens):
        s = shapes[i : i + 5]
        left, right = "_" if gaps[i] else "", "_" if gaps[i + 1] else ""
        out.append(
            ["1", f"0{s[2]}", f"-{s[1]}{left}{s[2]}", f"+{s[2]}{right}{s[3]}", f"={s[1]}{left}{s[2]}{right}{s[3]}", f"<{s[0]}{s[1]}{left}{s[2]}", f">{s[2]}{right}{s[3]}{s[4]}"]
            + ([f"w{token.lower()}"] if token.isalpha() and len(token) <= 8 else [])
            + ([f"8{int(token) <= 255}{s[1]}{s[3]}"] if token[0] in "0123456789" and len(token) <= 3 else [])
        )
    return out


class Field:
    """Weights of features and of label pairs."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.index, self.emit, self.move = index, emit, move

    def emissions(self, features: list[list[str]]) -> np.ndarray:
        get = self.index.get
        out = np.zeros((len(features), len(LABELS)))
        for i, names in enumerate(features):
            known = [k for k in map(get, names) if k is not None]
            out[i] = self.emit[known].sum(axis=0)
        return out

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best label paths; sequences of similar length share one Viterbi pass."""
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        paths: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at + 1) * len(sequences[order[end]]) <= 100_000:
                end += 1
            group = order[at:end]
            for i, path in zip(group, self._viterbi([sequences[i] for i in group])):
                paths[i] = path
            at = end
        return paths

    def _viterbi(self, group: list[np.ndarray]) -> list[np.ndarray]:
        sizes = np.array([len(s) for s in group])
        n, steps, k = len(group), int(sizes.max()), len(LABELS)
        if steps == 0:
            return [np.zeros(0, np.int64)] * n
        scores = np.zeros((n, steps, k))
        for i, s in enumerate(group):
            scores[i, : len(s)] = s
        best, back = scores[:, 0].copy(), np.zeros((n, steps, k), np.int8)
        for t in range(1, steps):
            across = best[:, :, None] + self.move
            back[:, t] = across.argmax(axis=1)
            new = across.max(axis=1) + scores[:, t]
            best = np.where((t < sizes)[:, None], new, best)
        label = best.argmax(axis=1)
        out = np.zeros((n, steps), np.int64)
        for t in range(steps - 1, -1, -1):
            inside = t < sizes
            out[inside, t] = label[inside]
            label = np.where(inside & (t > 0), back[np.arange(n), t, label], label)
        return [o[:s] for o, s in zip(out, sizes)]


def _labelled() -> list[tuple[list[list[str]], np.ndarray]]:
    """Features and labels of the table's lines."""
    data = []
    for line in LABELLED:
        plain, spans, end = "", [], 0
        for m in _MARK.finditer(line):
            plain += line[end : m.start()]
            spans.append((m.group(1), len(plain), len(plain) + len(m.group(2))))
            plain, end = plain + m.group(2), m.end()
        plain += line[end:]
        tokens = [(*m.span(), m.group()) for m in _TOKEN.finditer(plain)]
        labels = np.zeros(len(tokens), np.int64)
        for kind, start, stop in spans:
            inside = [i for i, (a, b, _) in enumerate(tokens) if start <= a and b <= stop]
            labels[inside] = LABELS.index(f"I-{kind}")
            labels[inside[0]] = LABELS.index(f"B-{kind}")
        data.append((_features(tokens), labels))
    return data


def train(rounds: int = 120, rate: float = 0.3, decay: float = 2e-3) -> Field:
    """Maximum likelihood with a quadratic penalty, by full gradient steps scaled per weight."""
    data = _labelled()
    index: dict[str, int] = {}
    for features, _ in data:
        for names in features:
            for name in names:
                index.setdefault(name, len(index))
    k = len(LABELS)
    emit, move = np.zeros((len(index), k)), np.zeros((k, k))
    # an inside label only follows a label of its kind
    barred = np.zeros((k, k))
    for b, name in enumerate(LABELS):
        if name.startswith("I-"):
            barred[[a for a, other in enumerate(LABELS) if other[2:] != name[2:]], b] = -30
    seen_emit, seen_move = np.full(emit.shape, 1e-3), np.full(move.shape, 1e-3)
    ids = [[np.array([index[n] for n in names]) for names in features] for features, _ in data]
    for _ in range(rounds):
        grad_emit, grad_move = decay * emit, decay * move
        for rows_, (_, labels) in zip(ids, data):
            score = np.stack([emit[r].sum(axis=0) for r in rows_])
            step = move + barred
            n = len(score)
            ahead, behind = np.zeros((n, k)), np.zeros((n, k))
            ahead[0] = score[0]
            for t in range(1, n):
                ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, None] + step, axis=0) + score[t]
            for t in range(n - 2, -1, -1):
                behind[t] = np.logaddexp.reduce(step + score[t + 1] + behind[t + 1], axis=1)
            total = np.logaddexp.reduce(ahead[-1])
            expected = np.exp(ahead + behind - total)
            expected[np.arange(n), labels] -= 1
            for r, e in zip(rows_, expected):
                grad_emit[r] += e / len(data)
            for t in range(1, n):
                grad_move += np.exp(ahead[t - 1][:, None] + step + score[t] + behind[t] - total) / len(data)
                grad_move[labels[t - 1], labels[t]] -= 1 / len(data)
        seen_emit += grad_emit**2
        seen_move += grad_move**2
        emit -= rate * grad_emit / np.sqrt(seen_emit)
        move -= rate * grad_move / np.sqrt(seen_move)
    return Field(index, emit, move + barred)


@cache
def field() -> Field:
    """The trained field; the table is small, so each Python worker trains it once and alike."""
    return train()


def stretches(text: str) -> list[list[tuple[int, int, str]]]:
    """Tokens around digits and @: neighbouring words that hold one, with ``CONTEXT`` plain words on each side."""
    if not _TRIGGER.search(text):
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    marked = [i for i, (a, b) in enumerate(words) if _TRIGGER.search(text, a, b)]
    out, at = [], 0
    while at < len(marked):
        end = at
        while end + 1 < len(marked) and marked[end + 1] - marked[end] <= 2 * CONTEXT:
            end += 1
        first, last = max(0, marked[at] - CONTEXT), min(len(words) - 1, marked[end] + CONTEXT)
        out.append([(*m.span(), m.group()) for m in _TOKEN.finditer(text, words[first][0], words[last][1])])
        at = end + 1
    return out


def _plausible(kind: str, found: str) -> bool:
    digits = _digits(found)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        parts = found.split(".") if "." in found else found.split(":")
        if "." in found:
            return len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in parts)
        return len(parts) == 8 and all(1 <= len(p) <= 4 and all(c in "0123456789abcdefABCDEF" for c in p) for p in parts)
    return found.count("@") == 1 and not found.startswith("@") and not found.endswith("@")


def all_spans(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text; spans of the field that touch an earlier one are left out."""
    found = [base_spans(t) for t in texts]
    owners, tokens = [], []
    for i, text in enumerate(texts):
        for stretch in stretches(text):
            owners.append(i)
            tokens.append(stretch)
    model = field()
    paths = model.decode([model.emissions(_features(t)) for t in tokens])
    added: dict[int, list[Span]] = {}
    for i, stretch, path in zip(owners, tokens, paths):
        at = 0
        while at < len(path):
            name = LABELS[path[at]]
            end = at + 1
            if name != "O":
                while end < len(path) and LABELS[path[end]] == f"I-{name[2:]}":
                    end += 1
                span = (name[2:], stretch[at][0], stretch[end - 1][1])
                if _plausible(span[0], texts[i][span[1] : span[2]]):
                    added.setdefault(i, []).append(span)
            at = end
    out = []
    for i, base in enumerate(found):
        taken = sorted((a, b) for _, a, b in base)
        new = [s for s in added.get(i, ()) if not any(a < s[2] and s[1] < b for a, b in taken)]
        out.append((_ordered(base), _ordered(base + new)))
    return out


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _groups(found: Iterator[tuple], size: int = 8 << 20) -> Iterator[list[tuple]]:
    """Rows in lists of bounded text, decoded together."""
    held, weight = [], 0
    for row in found:
        held.append(row)
        weight += len(row[1])
        if weight >= size:
            yield held
            held, weight = [], 0
    if held:
        yield held


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one per row of ``docs``.

    Counts and the digest are of the base spans, ``spans`` lists all as ``kind:start:end`` in code points, by kind and
    start. Null and empty texts have no spans. Repeated rows give repeated results, empty tables none; other columns
    are not read. Nothing is shuffled.
    """
    slim = docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_raw"))
    counts = [f"n_{k}" for k in KINDS]
    schema = T.StructType([slim.schema["_id"]] + [T.StructField(c, T.LongType(), False) for c in counts] + [T.StructField(c, T.StringType(), False) for c in ("base_sha256", "spans")])

    def run(parts):
        for batch in parts:
            out = pa.schema([batch.schema.field("_id")] + [pa.field(c, pa.int64(), False) for c in counts] + [pa.field(c, pa.string(), False) for c in ("base_sha256", "spans")])

            def records(batch=batch):
                for group in _groups(rows(batch, "_id", "_raw")):
                    for (key, _), (base, every) in zip(group, all_spans([raw.decode("utf-8", "replace") for _, raw in group])):
                        numbers = [sum(s[0] == k for s in base) for k in KINDS]
                        yield key, *numbers, hashlib.sha256(written(base).encode()).hexdigest(), written(every)

            yield from batches(records(), out)

    return slim.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; of spans that overlap the first counts."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
        elif end > at:
            at = end
    return "".join(out) + text[at:]


def mask(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows of ``docs`` with every span of the text masked; ``length_col``, if there is one, becomes the new length.

    Null texts stay null with their length as it was; other columns are unchanged.
    """
    names = docs.columns

    def run(parts):
        take_turn()
        for batch in parts:
            column = batch.column(names.index(text_col))
            new: list[str | None] = [None] * batch.num_rows
            for group in _groups((i, t.as_py()) for i, t in enumerate(column) if t.is_valid):
                for (i, text), (_, spans) in zip(group, all_spans([t for _, t in group])):
                    new[i] = masked(text, spans) if spans else text
            yield batch.set_column(names.index(text_col), text_col, pa.array(new, column.type))
        pa.default_memory_pool().release_unused()

    changed = docs.mapInArrow(run, docs.schema)
    if length_col in names:
        kind = docs.schema[length_col].dataType
        changed = changed.withColumn(length_col, F.coalesce(F.length(text_col).cast(kind), F.col(length_col)))
    return changed
