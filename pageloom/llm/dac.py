"""Token ids in files with direct access to any token.

Directly addressable codes: an id is split into chunks of ``CHUNK`` bits, lowest first. Level k holds chunk k of
every id that has one, a bitmap that says which of them go on to level k + 1, and a rank directory with the number
of ones before every ``RANK_BLOCK`` bits of the bitmap. The place of an id on the next level is the rank of its
bit, so one id or any slice is read without touching what lies around it.

A segment is one byte string: header, levels, document table. Segments are rows of a Parquet folder: Spark's writer
commits whole tasks only, so a lost executor leaves no half-written segment, and any store that Spark reads will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import compress, repeat
from operator import is_
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from pageloom.llm.words import batches, rows, take_turn, text_bytes

MAGIC = b"DAC1"
CHUNK = 8
RANK_BLOCK = 512
#: A segment is closed once it has this many ids or documents; one longer document has a segment of its own.
SEGMENT_IDS = 1 << 20
SEGMENT_DOCS = 20_000
#: Words a worker remembers with their ids, per generation; about 200 bytes each, two generations at most.
REMEMBERED = 800_000
#: Text handled at once, so that the tokenizer is called for many new words together.
GROUP_BYTES = 2 << 20
#: Marks that may follow a word; no apostrophe, which the tokenizer treats apart.
MARKS = b".,!?;:*$%&#|()\""

_COUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _pad(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


def pack(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One segment: all ids in order, and how many belong to each document."""
    levels, left = [], ids.astype(np.uint32)
    while len(left):
        more = left >> CHUNK
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little").tobytes()
        bits += b"\0" * (-len(bits) % (RANK_BLOCK // 8))
        per_block = _COUNT[np.frombuffer(bits, np.uint8)].reshape(-1, RANK_BLOCK // 8).sum(1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(per_block, dtype=np.uint32)[:-1]]).astype("<u4")
        levels.append((len(left), _pad((left & 0xFF).astype(np.uint8).tobytes()), bits, _pad(ranks.tobytes())))
        left = more[goes_on]
    head = MAGIC + struct.pack("<BxxxQQ", len(levels), len(ids), len(lengths))
    body = b"".join(struct.pack("<Q", n) + chunks + bits + ranks for n, chunks, bits, ranks in levels)
    return head + body + np.asarray(lengths, "<u8").tobytes()


class Segment:
    """Reader over the bytes of one segment; views only, nothing is decoded ahead."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a segment")
        n_levels, self.n_ids, self.n_docs = struct.unpack_from("<BxxxQQ", raw, 4)
        self.levels, at = [], 24
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", raw, at)
            at += 8
            chunks = np.frombuffer(raw, np.uint8, n, at)
            at += n + -n % 8
            n_blocks = -(-n // RANK_BLOCK)
            bits = np.frombuffer(raw, np.uint8, n_blocks * RANK_BLOCK // 8, at)
            at += len(bits)
            ranks = np.frombuffer(raw, "<u4", n_blocks, at)
            at += 4 * n_blocks + -4 * n_blocks % 8
            self.levels.append((chunks, bits, ranks))
        self.lengths = np.frombuffer(raw, "<u8", self.n_docs, at)

    def rank(self, level: int, at: int) -> int:
        """Ones before bit ``at``: one directory entry and at most one block of the bitmap."""
        chunks, bits, ranks = self.levels[level]
        block = at // RANK_BLOCK
        if block >= len(ranks):
            block = len(ranks) - 1
        first = block * RANK_BLOCK // 8
        whole = at // 8
        ones = int(ranks[block]) + int(_COUNT[bits[first:whole]].sum())
        rest = at % 8
        return ones + (int(_COUNT[bits[whole] & ((1 << rest) - 1)]) if rest else 0)

    def token(self, at: int) -> int:
        """The id at one place."""
        value, shift = 0, 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[at]) << shift
            if not bits[at >> 3] >> (at & 7) & 1:
                break
            at, shift = self.rank(level, at), shift + CHUNK
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to ``end``."""
        out = np.zeros(end - start, "<u4")
        where, shift = np.arange(end - start), 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            if start >= end:
                break
            out[where] |= chunks[start:end].astype(np.uint32) << np.uint32(shift)
            span = np.unpackbits(bits[start >> 3 : -(-end // 8)], bitorder="little")[start & 7 :][: end - start].astype(bool)
            where, shift = where[span], shift + CHUNK
            start = self.rank(level, start)
            end = start + len(where)
        return out


class _Words:
    """Ids of white-space separated words as little-endian 32-bit values."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}
        # the same vocabulary and merges for words that normalising and cutting would leave as they are
        self.lean = Tokenizer.from_file(path)
        self.lean.normalizer = None
        self.lean.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; lower-case words of letters share one call, as each of them ends at an id that ends words."""
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = [i for i, t in enumerate(texts) if t.isalpha() and t.islower()]
        letters = [texts[i] for i in plain]
        if not is_normalized("NFC", " ".join(letters)):
            plain = [i for i, t in zip(plain, letters) if is_normalized("NFC", t)]
            letters = [texts[i] for i in plain]
        out: list[bytes | None] = [None] * len(words)
        ids = np.zeros(0, "<u4")
        if plain:
            ids = np.array(self.lean.encode_batch_fast([letters], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        ends = np.nonzero(self.last[ids])[0] + 1
        if len(ends) == len(plain):
            raw, ends = ids.tobytes(), (4 * ends).tolist()
            for i, a, b in zip(plain, [0, *ends], ends):
                out[i] = raw[a:b]
        for i, found in enumerate(out):
            if found is None:
                out[i] = np.array(self._ids(texts[i]), "<u4").tobytes()
        return out

    def _fill(self, gaps: dict[bytes, bytes | None]) -> None:
        """Ids of the words that have none yet, put together from a core and the marks after it where that is exact.

        The tokenizer lower-cases and never joins marks with a letter or digit before them, so ``Word`` and ``word,``
        need no call of their own once ``word`` is known.
        """
        known, older, cut, new = self.known, self.older, [], {}
        for w, ids in gaps.items():
            if ids is None:
                core = w.rstrip(MARKS)
                if core[-1:].isalnum() and b"<|" not in w:
                    marks = w[len(core) :]
                    core = core.lower()
                    if core != w:
                        cut.append((w, core, marks))
                        for part in (core, marks) if marks else (core,):
                            if part not in known and part not in new:
                                new[part] = older.get(part)
                        continue
                new[w] = None
        unknown = [p for p, ids in new.items() if ids is None]
        for at in range(0, len(unknown), 5_000):
            new.update(zip(unknown[at : at + 5_000], self.encode(unknown[at : at + 5_000])))
        gaps.update((p, new[p]) for p in unknown if p in gaps)
        known.update(new)
        for w, core, marks in cut:
            gaps[w] = known[core] + known[marks] if marks else known[core]

    def documents(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts; all their unknown words go to the tokenizer together."""
        words = [raw.split() for raw in texts]
        found = [list(map(self.known.get, w)) for w in words]
        holes = [list(compress(range(len(f)), map(is_, f, repeat(None)))) for f in found]
        gaps = {w[i]: None for w, h in zip(words, holes) for i in h}
        if gaps:
            gaps = {w: self.older.get(w) for w in gaps}
            self._fill(gaps)
            for w, f, h in zip(words, found, holes):
                for i in h:
                    f[i] = gaps[w[i]]
            self.known.update(gaps)
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
        return [b"".join(f) for f in found]


_known: dict[str, _Words] = {}


def _words(path: str) -> _Words:
    take_turn(_known.clear)
    if path not in _known:
        _known[path] = _Words(path)
    return _known[path]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending order of ``id_col``.

    The tokenizer must treat white-space separated words independently (its pattern never crosses white space), so a
    word seen before is not encoded again. Documents are dealt by ranges of ``id_col``; part numbers follow the
    ranges. Repeated ids stay in one part, ordered by text; null ids come first; a null text has the end id only.
    """
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(id_col).alias("key"), text_bytes(text_col).alias("_raw"))
        .repartitionByRange(n_parts, "key")
        .sortWithinPartitions("key", "_raw")
    )
    key_type = ordered.schema["key"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType(), False),
            T.StructField("before", T.LongType(), False),
            T.StructField("n_ids", T.LongType(), False),
            T.StructField("keys", T.ArrayType(key_type, True), False),
            T.StructField("segment", T.BinaryType(), False),
        ]
    )

    def run(parts):
        own, part, end = _words(tokenizer_path), TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        arrow_key = None

        def segments() -> Iterator[tuple]:
            nonlocal arrow_key
            keys, held, size, before = [], [], 0, 0
            for batch in parts:
                arrow_key = batch.schema.field(0).type
                for found in _groups(rows(batch, "key", "_raw")):
                    for (key, _), ids in zip(found, own.documents([raw for _, raw in found])):
                        keys.append(key)
                        held.append(ids + end)
                        size += len(held[-1]) // 4
                        if size >= SEGMENT_IDS or len(keys) >= SEGMENT_DOCS:
                            yield part, before, size, keys, _packed(held)
                            keys, held, size, before = [], [], 0, before + size
            if keys:
                yield part, before, size, keys, _packed(held)

        for row in segments():
            out = pa.schema(
                [
                    pa.field("part", pa.int32(), False),
                    pa.field("before", pa.int64(), False),
                    pa.field("n_ids", pa.int64(), False),
                    pa.field("keys", pa.list_(pa.field("element", arrow_key)), False),
                    pa.field("segment", pa.binary(), False),
                ]
            )
            yield from batches([row], out)

    ordered.mapInArrow(run, schema).write.mode("overwrite").option("compression", "zstd").parquet(folder)


def _groups(found: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows in lists of about ``GROUP_BYTES`` of text."""
    held, size = [], 0
    for row in found:
        held.append(row)
        size += len(row[1])
        if size >= GROUP_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _packed(held: list[bytes]) -> bytes:
    return pack(np.frombuffer(b"".join(held), "<u4"), np.array([len(h) // 4 for h in held], "<u8"))


def read_token_files(spark, folder: str) -> DataFrame:
    """Rows ``(key, start, n_tokens, ids_crc32)`` of a written folder.

    ``start`` counts the ids of all documents before it: those of earlier parts, summed over one row per part, and
    those before the segment in its part, which its row tells. Documents are read by slices of their segment.
    """
    table = spark.read.parquet(folder)
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    parts = parts.select("part", (F.sum("_ids").over(W.orderBy("part")) - F.col("_ids")).alias("_earlier"))
    # as many rows as the writer had partitions
    placed = table.join(F.broadcast(parts), "part").select((F.col("_earlier") + F.col("before")).alias("_start"), "keys", "segment")
    schema = T.StructType(
        [
            T.StructField("key", table.schema["keys"].dataType.elementType),
            T.StructField("start", T.LongType(), False),
            T.StructField("n_tokens", T.LongType(), False),
            T.StructField("ids_crc32", T.LongType(), False),
        ]
    )

    def run(found):
        for batch in found:
            out = pa.schema(
                [
                    pa.field("key", batch.schema.field("keys").type.value_type),
                    pa.field("start", pa.int64(), False),
                    pa.field("n_tokens", pa.int64(), False),
                    pa.field("ids_crc32", pa.int64(), False),
                ]
            )

            def documents(batch=batch):
                for first, keys, raw in rows(batch, "_start", "keys", "segment"):
                    segment, at = Segment(raw), 0
                    # all documents of the segment are wanted, so they are one slice
                    ids = memoryview(segment.tokens(0, segment.n_ids)).cast("B")
                    for key, n in zip(keys, segment.lengths.tolist()):
                        yield key, first + at, n, zlib.crc32(ids[4 * at : 4 * (at + n)])
                        at += n

            yield from batches(documents(), out)

    return placed.mapInArrow(run, schema)
