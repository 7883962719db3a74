"""Repeated passages by recompression: word runs and pairs get names, equal passages get equal names inside.

Round 0 names runs of one word, each later round names pairs whose left part falls on one side of a content-based
coin and whose right part on the other, so pairs never overlap. A name is a 64-bit digest of its parts: every task
gives the same name to the same content without asking another, where a table of names would move every symbol in
every round. With each symbol goes the span of words on which its making depended. A symbol whose span lies inside a
window is made alike wherever the window's words occur, so each window is filed under the longest of its symbols.

Spark then decides by counting: runs of windows under one symbol with equal context are repeats as a whole; a symbol
seen in several contexts has its windows compared one by one on 128 bits of their words; all others are unique.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import batches, combine, drop_folder, mix, packed, rows, text_bytes, word_hashes
from pageloom.session import ensure_checkpoint_dir, work_path

WINDOW = 35
#: Rounds of pair naming; more rounds make longer symbols, but fewer of them fit into a window whole.
ROUNDS = 4
#: Words handled at once; longer texts are cut into overlapping parts, which changes no name inside a window.
PART_WORDS = 200_000

_BASE = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Symbols:
    """Symbols over the words of several texts: names, first words, and the spans their making depends on."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS):
        """``bounds``: first word of each text in ``hashes``, and the end. Texts lie one place apart in span places."""
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        at = np.arange(len(hashes)) + text
        self.text, self.name = text, hashes
        self._runs(at)
        for r in range(rounds):
            self._pairs(np.array([r + 1], np.uint64))

    def _runs(self, at: np.ndarray) -> None:
        n = len(at)
        fresh = np.ones(n, bool)
        fresh[1:] = (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])
        first = np.nonzero(fresh)[0]
        length = np.diff(np.append(first, n))
        # a run ends where its neighbours differ, so one more word on each side decides
        self.low, self.high, self.words = at[first] - 1, at[first] + length + 1, length
        self.text = self.text[first]
        self.name = np.where(length > 1, combine(self.name[first], length.astype(np.uint64)), self.name[first])

    def _pairs(self, salt: np.ndarray) -> None:
        n = len(self.name)
        if n < 2:
            return
        left = (mix(self.name ^ mix(salt)) >> np.uint64(63)).astype(bool)
        near = self.text[1:] == self.text[:-1]
        joins = near & left[:-1] & ~left[1:]
        starts = np.append(joins, False)
        ends = np.append(False, joins)
        alone = ~starts & ~ends
        low, high = self.low.copy(), self.high.copy()
        # a left part stays alone because of its right neighbour, a right part because of its left neighbour
        needs_right = np.nonzero(alone[:-1] & left[:-1])[0]
        high[needs_right] = np.where(near[needs_right], np.maximum(high[needs_right], self.high[needs_right + 1]), high[needs_right])
        needs_left = np.nonzero(alone[1:] & ~left[1:])[0] + 1
        low[needs_left] = np.where(near[needs_left - 1], np.minimum(low[needs_left], self.low[needs_left - 1]), low[needs_left])
        begin = np.nonzero(starts)[0]
        name = self.name.copy()
        name[begin] = combine(self.name[begin], self.name[begin + 1])
        high[begin] = self.high[begin + 1]
        words = self.words.copy()
        words[begin] += self.words[begin + 1]
        stays = ~ends
        self.name, self.low, self.high, self.text, self.words = name[stays], low[stays], high[stays], self.text[stays], words[stays]

    def order(self) -> np.ndarray:
        """Longest first, equally long ones by name: long symbols rarely occur twice by chance."""
        short = np.uint64(63) - np.minimum(self.words, 63).astype(np.uint64)
        return (short << np.uint64(58)) | (self.name >> np.uint64(6))


class Digests:
    """Two 64-bit digests of any span of words."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums, self.inverse = [], []
        for lane, base in enumerate(_BASE):
            power = _powers(base, n + 1)
            words = hashes if lane == 0 else mix(hashes)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:n])]))
            self.inverse.append(_powers(pow(base, -1, 1 << 64), n + 1))

    def span(self, start: np.ndarray, end: np.ndarray, lane: int) -> np.ndarray:
        return mix((self.sums[lane][end] - self.sums[lane][start]) * self.inverse[lane][start])


_power_store: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _power_store.get(base)
    if known is None or len(known) < n:
        size = max(n, 2 * PART_WORDS)
        known = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))])
        if size <= 2 * PART_WORDS:
            _power_store[base] = known
    return known[:n]


def _argmin_tables(order: np.ndarray, longest: int) -> list[np.ndarray]:
    tables, width = [np.arange(len(order))], 1
    while 2 * width <= longest:
        last = tables[-1]
        a, b = last[:-width], last[width:]
        tables.append(np.where(order[a] <= order[b], a, b))
        width *= 2
    return tables


def filed_windows(hashes: np.ndarray, bounds: np.ndarray, window: int, rounds: int = ROUNDS):
    """Runs of neighbouring windows filed under one symbol: text, first word in the text, number, symbol, context.

    A window without a symbol of its own is a run by itself under its own digest.
    """
    sizes = np.diff(bounds)
    n_windows = np.maximum(0, sizes - window + 1)
    text = np.repeat(np.arange(len(sizes)), n_windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + bounds[text]
    if not len(start):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    symbols = Symbols(hashes, bounds, rounds)
    digests = Digests(hashes)
    place = start + text
    low = np.searchsorted(symbols.low, place, "left")
    high = np.searchsorted(symbols.high, place + window, "right")
    count = high - low
    owned = count > 0
    chosen = np.full(len(start), -1)
    if owned.any():
        order = symbols.order()
        tables = _argmin_tables(order, int(count.max()))
        level = np.zeros(len(count), np.int64)
        level[owned] = np.log2(count[owned]).astype(np.int64)
        for k, table in enumerate(tables):
            here = np.nonzero(owned & (level == k))[0]
            a, b = table[low[here]], table[high[here] - (1 << k)]
            chosen[here] = np.where(order[a] <= order[b], a, b)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | ~owned[1:] | (text[1:] != text[:-1])
    first = np.nonzero(fresh)[0]
    number = np.diff(np.append(first, len(start)))
    begin, end = start[first], start[first] + number - 1 + window
    own = owned[first]
    name = np.where(own, symbols.name[np.maximum(chosen[first], 0)], digests.span(begin, end, 0))
    offset = np.where(own, symbols.low[np.maximum(chosen[first], 0)] - place[first], -5)
    context = combine(digests.span(begin, end, 1), (offset * 1_000_003 + number).astype(np.uint64))
    return text[first], begin - bounds[text[first]], number, name, context


def _parts(texts: Iterator[tuple[int, list[bytes]]], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Word hashes of whole texts or overlapping parts, about ``PART_WORDS`` at once: hashes, bounds, (text, offset)."""
    held, places, size = [], [], 0
    for at, words in texts:
        hashes = word_hashes(words)
        for offset in range(0, max(1, len(hashes) - window + 1), PART_WORDS):
            part = hashes[offset : offset + PART_WORDS + window - 1]
            if len(part) < window:
                continue
            held.append(part)
            places.append((at, offset))
            size += len(part)
            if size >= PART_WORDS:
                yield np.concatenate(held), np.cumsum([0] + [len(h) for h in held]), places
                held, places, size = [], [], 0
    if held:
        yield np.concatenate(held), np.cumsum([0] + [len(h) for h in held]), places


def _anchors(slim: DataFrame, window: int) -> DataFrame:
    """One row per run of windows: digest of the text, first word, number of windows, symbol, context."""
    schema = T.StructType(
        [slim.schema["_th"]]
        + [T.StructField(n, T.IntegerType(), False) for n in ("pos", "n")]
        + [T.StructField(n, T.LongType(), False) for n in ("name", "context")]
    )

    def run(found):
        for batch in found:
            digest, raw = (batch.column(c) for c in ("_th", "_raw"))
            out = pa.schema(
                [pa.field("_th", digest.type)]
                + [pa.field(n, pa.int32(), False) for n in ("pos", "n")]
                + [pa.field(n, pa.int64(), False) for n in ("name", "context")]
            )
            texts = ((i, raw[i].as_py().split()) for i in range(batch.num_rows))
            for hashes, bounds, places in _parts(texts, window):
                text, pos, number, name, context = filed_windows(hashes, bounds, window)
                places = np.array(places)
                row = pa.array(places[text, 0])
                pos = pos + places[text, 1]
                yield pa.RecordBatch.from_arrays(
                    [digest.take(row), pa.array(pos, pa.int32()), pa.array(number, pa.int32())]
                    + [pa.array(name.view(np.int64)), pa.array(context.view(np.int64))],
                    schema=out,
                )

    return slim.mapInArrow(run, schema)


def _covered(n_words: int, starts: np.ndarray, numbers: np.ndarray, window: int) -> np.ndarray:
    """Words inside any of the runs of windows."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + numbers - 1 + window, n_words), -1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows ``(id, n_words, n_removed, kept)``, one per row of ``docs``; ``kept`` is the text left, words joined by blanks.

    Every word covered by a window of ``window`` consecutive words whose sequence also starts elsewhere, in any row or
    the same one, is removed; windows are judged on the input. Null and wordless texts have no words and keep an empty
    text; repeated rows repeat each other, so long ones lose all words; other columns are not read.
    """
    return _finish(docs, id_col, text_col, window, False)


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows ``(id, n_words, n_removed, kept_sha256)``: as ``remove_repeats``, with the text left as a hex digest."""
    return _finish(docs, id_col, text_col, window, True)


def _finish(docs: DataFrame, id_col: str, text_col: str, window: int, digest: bool) -> DataFrame:
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    slim = docs.select(text_bytes(text_col).alias("_raw")).withColumn("_th", F.unhex(F.md5("_raw")))
    anchors_at, shared_at, opened_at = (work_path(spark, name) for name in ("anchors", "shared-anchors", "passages"))
    _anchors(slim, window).write.option("compression", "zstd").parquet(anchors_at)
    anchors = spark.read.parquet(anchors_at)

    names = anchors.groupBy("name").agg(F.count("*").alias("times"), F.min("context").alias("one"), F.max("context").alias("other"))
    # checkpointed, so that the join has plain exchanges on both sides and Spark can split a frequent symbol's rows
    names = names.where("times > 1").select("name", (F.col("one") != F.col("other")).alias("mixed")).checkpoint()
    anchors.join(names, "name").write.option("compression", "zstd").parquet(shared_at)
    drop_folder(spark, anchors_at)
    shared = spark.read.parquet(shared_at)

    # a symbol with one context repeats as it is; of mixed ones each context that occurs twice does, and the windows
    # of one sample per context are compared with those of the other contexts
    mixed = shared.where("mixed")
    contexts = mixed.groupBy("name", "context").agg(F.count("*").alias("times"), F.min(F.struct("_th", "pos")).alias("sample"))
    judged = mixed.join(contexts, ["name", "context"]).select(
        "_th", "pos", "n", (F.col("times") > 1).alias("whole"), (F.struct("_th", "pos") == F.col("sample")).alias("opened")
    )
    simple = shared.where("not mixed").select("_th", "pos", "n", F.lit(True).alias("whole"), F.lit(False).alias("opened"))
    # copies of a text have the same runs: each counts above, one list stands for all of them from here
    listed = judged.where("whole or opened").unionAll(simple).groupBy("_th").agg(F.collect_set(F.struct("pos", "n", "whole", "opened")).alias("runs"))
    _open(slim, listed, window, digest).write.option("compression", "zstd").parquet(opened_at)
    drop_folder(spark, shared_at)
    opened = spark.read.parquet(opened_at)
    waiting = opened.where("n_removed is null")

    # equal first digests first, which leaves few rows, then both
    windows = waiting.select("_th", F.explode(F.arrays_zip("at", "twice", "a", "b")).alias("w")).select("_th", "w.*")
    alike = windows.groupBy("a").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("times")).where("times > 1").select("a")
    likely = windows.join(alike, "a", "left_semi").checkpoint()
    again = likely.groupBy("a", "b").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("times")).where("times > 1").select("a", "b")
    single = likely.where("not twice").join(again, ["a", "b"], "left_semi").groupBy("_th").agg(F.collect_set("at").alias("hits"))
    both = waiting.select("_th", "runs", "text").join(single, "_th", "left")
    done = _close(both.select("_th", "text", "runs", "hits"), window, digest)
    finished = opened.where("n_removed is not null").select("_th", "n_words", "n_removed", "kept").unionAll(done)
    # every row takes what its text came to; plain exchanges on both sides, so Spark can split the rows of a frequent text
    keyed = docs.select(F.col(id_col).alias("doc"), F.unhex(F.md5(text_bytes(text_col))).alias("_th"))
    rowwise = keyed.join(finished, "_th").select("doc", "n_words", "n_removed", "kept")
    return rowwise.withColumnsRenamed({"doc": id_col, "kept": "kept_sha256" if digest else "kept"})


def _kept(words: list[bytes], digest: bool) -> str:
    left = b" ".join(words)
    return hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "replace")


def _finished(raw: bytes, runs: list[tuple[int, int]], window: int, digest: bool) -> tuple[int, int, str]:
    """Number of words, of removed words, and what is left, for runs of repeated windows ``(first, number)``."""
    words = raw.split()
    if not runs:
        return len(words), 0, _kept(words, digest)
    gone = _covered(len(words), *np.array(runs, dtype=np.int64).T, window)
    left = [w for w, g in zip(words, gone.tolist()) if not g]
    return len(words), len(words) - len(left), _kept(left, digest)


def _open(slim: DataFrame, listed: DataFrame, window: int, digest: bool) -> DataFrame:
    """Different texts without windows to compare are finished here; the others wait with their runs and those windows."""
    # copies are combined before the shuffle, so a text leaves each task once
    texts = packed(slim, "_raw").groupBy("_th").agg(F.first("_raw").alias("_raw"))
    joined = texts.join(listed, "_th", "left").select("_th", "_raw", "runs")
    run_type = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("number", T.IntegerType())]))
    schema = T.StructType(
        [T.StructField("_th", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
        + [T.StructField("kept", T.StringType()), T.StructField("text", T.BinaryType()), T.StructField("runs", run_type)]
        + [T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("twice", T.ArrayType(T.BooleanType()))]
        + [T.StructField(lane, T.ArrayType(T.LongType())) for lane in ("a", "b")]
    )

    def opened(raw: bytes, runs: list[dict]) -> tuple:
        hashes = word_hashes(raw.split())
        open_runs = [(r["pos"], r["n"], r["whole"]) for r in runs if r["opened"]]
        start = np.concatenate([np.arange(p, p + n) for p, n, _ in open_runs] or [np.zeros(0, np.int64)]).astype(np.int64)
        twice = np.repeat([w for _, _, w in open_runs], [n for _, n, _ in open_runs]).astype(bool)
        a, b = (np.zeros(len(start), np.int64) for _ in range(2))
        # spans are digested part by part, so that their powers stay few
        for first in range(0, len(hashes), PART_WORDS):
            here = np.nonzero((start >= first) & (start < first + PART_WORDS))[0]
            if len(here):
                digests = Digests(hashes[first : first + PART_WORDS + window])
                own = start[here] - first
                a[here], b[here] = (digests.span(own, own + window, lane).view(np.int64) for lane in (0, 1))
        whole = [{"pos": r["pos"], "number": r["n"]} for r in runs if r["whole"]]
        return whole, start.astype(np.int32), twice, a, b

    def run(found):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in found:
            out = pa.schema(
                [pa.field("_th", pa.binary()), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64())]
                + [pa.field("kept", pa.string()), pa.field("text", pa.binary()), pa.field("runs", pa.list_(pa.struct([("pos", pa.int32()), ("number", pa.int32())])))]
                + [pa.field("at", pa.list_(pa.int32())), pa.field("twice", pa.list_(pa.bool_()))]
                + [pa.field(lane, pa.list_(pa.int64())) for lane in ("a", "b")]
            )

            def records(batch=batch):
                for th, parcel, runs in rows(batch, "_th", "_raw", "runs"):
                    raw = unpack(parcel)
                    if any(r["opened"] for r in runs or ()):
                        yield th, None, None, None, parcel, *opened(raw, runs)
                    else:
                        yield th, *_finished(raw, [(r["pos"], r["n"]) for r in runs or ()], window, digest), None, None, None, None, None, None

            yield from batches(records(), out)

    return joined.mapInArrow(run, schema)


def _close(both: DataFrame, window: int, digest: bool) -> DataFrame:
    schema = T.StructType(
        [T.StructField("_th", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )

    def run(found):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in found:
            out = pa.schema([pa.field("_th", pa.binary()), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept", pa.string())])

            def records(batch=batch):
                for th, parcel, runs, hits in rows(batch, "_th", "text", "runs", "hits"):
                    found = [(r["pos"], r["number"]) for r in runs] + [(at, 1) for at in hits or ()]
                    yield th, *_finished(unpack(parcel), found, window, digest)

            yield from batches(records(), out)

    return both.mapInArrow(run, schema)
