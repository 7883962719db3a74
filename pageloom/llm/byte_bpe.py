"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece exactly one token can end its encoding. ``PrefixTable`` stores that token per
prefix, found from the tokens stored before it and a test of the two tokens that meet. The table answers for every
prefix at once, grows by appended bytes without looking back, and after an edit is filled again only from the edit
to the point where it falls into step with the old table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import batches, rows, take_turn, text_bytes

#: Pieces of one generation that a worker remembers with their ids; it keeps two generations at most.
REMEMBERED = 300_000
#: Pairs of tokens whose meeting a worker remembers.
PAIRS = 400_000
#: Pieces up to this many characters are remembered.
SHORT = 64
#: Texts over this many characters are cut into pieces one by one instead of into one list.
LONG_TEXT = 2_000_000


class PrefixBpe:
    """Rules of one vocabulary: ranks of byte strings, equal to their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._meets: dict[int, bool] = {}

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for single bytes and tokens no merge makes."""
        if token not in self._parts:
            text = self.tokens[token]
            seq = [self.ranks[text[i : i + 1]] for i in range(len(text))]
            while len(seq) > 2:
                best = min((self.ranks.get(self.tokens[a] + self.tokens[b], 1 << 60), i) for i, (a, b) in enumerate(zip(seq, seq[1:])))
                if best[0] == 1 << 60:
                    break
                seq[best[1] : best[1] + 2] = [best[0]]
            self._parts[token] = (seq[0], seq[1]) if len(seq) == 2 else None
        return self._parts[token]

    def reachable(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.parts(token) is not None

    def meets(self, left: int, right: int) -> bool:
        """True if merging the joined bytes leaves exactly these two tokens."""
        key = left << 32 | right
        known = self._meets.get(key)
        if known is None:
            if len(self._meets) >= PAIRS:
                self._meets.clear()
            known = self._meets[key] = self._boundary_holds(left, right)
        return known

    def _boundary_holds(self, left: int, right: int) -> bool:
        """Undo the merges beside the boundary, newest first; at no moment may the facing tokens merge earlier."""
        before = 1 << 60
        while True:
            across = self.ranks.get(self.tokens[left] + self.tokens[right])
            if across is not None and across < before:
                return False
            of_left, of_right = self.parts(left), self.parts(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and left > right):
                before, left = left, of_left[1]
            else:
                # the same merge across the boundary would lie further left and so come first
                before, right = right + 1, of_right[0]

    def table(self, text: bytes = b"") -> PrefixTable:
        return PrefixTable(self, text)

    def encode_piece(self, text: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(text)
        return (whole,) if whole is not None else tuple(PrefixTable(self, text).ids())

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """Last token of the encoding of every prefix of ``text``."""

    def __init__(self, bpe: PrefixBpe, text: bytes = b""):
        self.bpe = bpe
        self.text = b""
        self.last: list[int] = []
        self.append(text)

    def append(self, more: bytes) -> None:
        """Extend the text; entries of shorter prefixes stay as they are."""
        self.text += more
        text, last, bpe, rank, known = self.text, self.last, self.bpe, self.bpe.ranks.get, self.bpe._meets.get
        for end in range(len(last) + 1, len(text) + 1):
            for start in range(end - bpe.longest if end > bpe.longest else 0, end):
                token = rank(text[start:end])
                if token is not None:
                    if start:
                        left = last[start - 1]
                        fits = known(left << 32 | token)
                        if fits is None:
                            fits = bpe.meets(left, token)
                    else:
                        fits = bpe.reachable(token)
                    if fits:
                        last.append(token)
                        break
            else:
                raise ValueError("the vocabulary lacks a single byte")

    def _token_ending_at(self, end: int) -> int:
        text, ranks, last, bpe = self.text, self.bpe.ranks, self.last, self.bpe
        for start in range(max(0, end - bpe.longest), end):
            token = ranks.get(text[start:end])
            if token is not None and (bpe.meets(last[start - 1], token) if start else bpe.reachable(token)):
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def replace(self, start: int, end: int, with_: bytes) -> int:
        """Put ``with_`` in place of bytes ``start`` to ``end``; returns how many entries were computed anew."""
        old, shift = self.last, len(with_) - (end - start)
        self.text = self.text[:start] + with_ + self.text[end:]
        self.last = old[:start]
        in_step, computed = 0, 0
        edited = start + len(with_)
        while len(self.last) < len(self.text):
            at = len(self.last)
            token = self._token_ending_at(at + 1)
            computed += 1
            in_step = in_step + 1 if at >= edited and token == old[at - shift] else 0
            self.last.append(token)
            # an entry depends on the bytes and entries of one longest token before it
            if in_step >= self.bpe.longest:
                self.last += old[at + 1 - shift :]
                break
        return computed

    def ids(self, length: int | None = None) -> list[int]:
        """Token ids of the text, or of its first ``length`` bytes."""
        at, out = len(self.text) if length is None else length, []
        while at:
            out.append(self.last[at - 1])
            at -= len(self.bpe.tokens[out[-1]])
        return out[::-1]


class _Pieces(dict):
    """Ids by piece; unknown pieces are encoded through their prefix table."""

    def __init__(self, bpe: PrefixBpe):
        self.bpe, self.older = bpe, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.bpe.encode_piece(piece.encode())
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class TextCodec:
    """Whole texts: every match of ``pattern`` is a piece with its own encoding."""

    def __init__(self, bpe: PrefixBpe, pattern: str):
        self.bpe, self.pattern, self.known = bpe, regex.compile(pattern), _Pieces(bpe)

    def parts(self, text: str) -> Iterator[list[int]]:
        """Ids of the text, in lists of bounded length."""
        find = self.known.__getitem__
        if len(text) <= LONG_TEXT:
            yield list(chain.from_iterable(map(find, self.pattern.findall(text))))
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, 100_000)):
            yield list(chain.from_iterable(map(find, part)))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.parts(text)))


_codecs: dict[tuple[str, str], TextCodec] = {}


def codec(ranks_path: str, pattern: str) -> TextCodec:
    """The codec of a rank file (base64 bytes and rank per line); one per Python worker."""
    take_turn(_codecs.clear)
    key = (ranks_path, pattern)
    if key not in _codecs:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _codecs[key] = TextCodec(PrefixBpe(ranks), pattern)
    return _codecs[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, ids array<int>)``, one per row of ``docs``; a null text counts as empty and has no ids.

    Repeated rows give repeated results; other columns of ``docs`` are not read. Bytes that are not UTF-8 count as
    U+FFFD. The rank file must lie at the same path on every machine, as any installed package does.
    """
    slim = docs.select(F.col(id_col), text_bytes(text_col).alias("_raw"))
    schema = T.StructType([slim.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(parts):
        own = codec(ranks_path, pattern)
        for batch in parts:
            out = pa.schema([pa.field(id_col, batch.schema.field(0).type), pa.field("ids", pa.list_(pa.field("element", pa.int32(), False)), False)])
            yield from batches(((key, own.encode(raw.decode("utf-8", "replace"))) for key, raw in rows(batch, id_col, "_raw")), out, weight=1 << 19)

    return slim.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_tokens, ids_sha256, decoded_sha256)``: texts encoded, ids decoded again, both digested in the task.

    Same rules as ``encode_documents``; ids never leave the task, so a text of any length costs its own size only.
    """
    slim = docs.select(F.col(id_col), text_bytes(text_col).alias("_raw"))
    fields = [("n_tokens", T.LongType(), pa.int64()), ("ids_sha256", T.StringType(), pa.string()), ("decoded_sha256", T.StringType(), pa.string())]
    schema = T.StructType([slim.schema[0]] + [T.StructField(n, t, False) for n, t, _ in fields])

    def run(parts):
        own = codec(ranks_path, pattern)
        decimal = {i: str(i) for i in own.bpe.tokens}.__getitem__

        def digest(raw: bytes) -> tuple[int, str, str]:
            n, ids_sha, decoded_sha = 0, hashlib.sha256(), hashlib.sha256()
            for ids in own.parts(raw.decode("utf-8", "replace")):
                ids_sha.update(("," * (n > 0 and len(ids) > 0) + ",".join(map(decimal, ids))).encode())
                decoded_sha.update(own.bpe.decode(ids))
                n += len(ids)
            return n, ids_sha.hexdigest(), decoded_sha.hexdigest()

        for batch in parts:
            out = pa.schema([pa.field(id_col, batch.schema.field(0).type)] + [pa.field(n, t, False) for n, _, t in fields])
            yield from batches(((key, *digest(raw)) for key, raw in rows(batch, id_col, "_raw")), out)

    return slim.mapInArrow(run, schema)
