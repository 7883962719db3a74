"""Test items inside long documents: MinHash containment search over size partitions, verified on full shingle sets.

The Jaccard similarity of a short item and a long document is tiny even if the document holds the whole item, so
neither side is compared as it is. Items are partitioned by size. For each partition with upper size u a document is
cut into overlapping windows of 2u shingles, u apart: a passage of at most u shingles always lies inside one window,
and the containment threshold turns into a Jaccard bound that depends on the partition alone. From that bound the
number of hash functions follows for the wanted recall; windows and items that share one minimum are candidates.
Scattered passages are found as well: the chances of the windows that hold parts add up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import Shared, batches, rows, shingle_hashes, take_turn, text_bytes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999999
#: Smallest upper size over 1.
STEP = 8
#: Items of up to this many shingles are looked up shingle by shingle (windows of one).
TINY = 4
#: Bounds of what one pass broadcasts; more items take more passes over the documents.
BLOCK_ITEMS = 2_000
BLOCK_BYTES = 8 << 20
#: Positions handled at once, so that a document of any length needs bounded memory.
SPAN = 1 << 15


def shingles(words: list[bytes], k: int) -> set[bytes]:
    """Distinct runs of ``k`` words; the whole text if it has fewer, nothing without words."""
    if not words:
        return set()
    k = min(k, len(words))
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def upper_size(n: int) -> int:
    """Upper size of the partition of an item of ``n`` shingles: 1 for tiny ones, else 8, 12, 16, 24, 32, 48, 64 ..."""
    if n <= TINY:
        return 1
    u = STEP
    while u < n:
        # a power of two, then one and a half times it
        u = u + u // 2 if u & (u - 1) == 0 else u // 3 * 4
    return u


def hashes_needed(smallest: int, upper: int, threshold: float, recall: float) -> int:
    """Hash functions that find a window holding ``threshold`` of an item with the wanted probability."""
    if upper == 1:
        return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold))) if threshold < 1 else 1
    jaccard = threshold * smallest / (2 * upper + (1 - threshold) * smallest)
    return math.ceil(math.log(1 - recall) / math.log(1 - jaccard))


class ItemIndex:
    """Minima of a bounded block of items, ready to be met by the windows of documents."""

    def __init__(self, items: list[tuple[object, bytes]], k: int, threshold: float, recall: float):
        self.k, self.threshold = k, threshold
        self.items = []
        for key, raw in items:
            words = raw.split()
            if words:
                self.items.append((key, min(k, len(words)), shingles(words, k), shingle_hashes(word_hashes(words), k)))
        #: (shingle length, upper size) -> items
        groups: dict[tuple[int, int], list[int]] = {}
        for at, (_, length, _, hashes) in enumerate(self.items):
            groups.setdefault((length, upper_size(len(hashes))), []).append(at)
        rng = np.random.default_rng(20)
        multipliers = rng.integers(0, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        #: shingle length -> multipliers, and by upper size the look-up of its items
        self.groups: dict[int, tuple[np.ndarray, dict[int, tuple]]] = {}
        for (length, upper), members in sorted(groups.items()):
            n = hashes_needed(min(len(self.items[m][2]) for m in members), upper, threshold, recall)
            a = multipliers[: min(n, len(multipliers))]
            minima = np.stack([(self.items[m][3][None, :] * a[:, None]).min(axis=1) for m in members], axis=1)
            seen = np.zeros((len(a), 1 << 16), dtype=bool)
            seen[np.arange(len(a))[:, None], minima >> np.uint64(48)] = True
            where: dict[tuple[int, int], list[int]] = {}
            for i in range(len(a)):
                for m, value in zip(members, minima[i].tolist()):
                    where.setdefault((i, value), []).append(m)
            _, sizes = self.groups.setdefault(length, (a, {}))
            sizes[upper] = (len(a), seen, where)
        for length, (_, sizes) in self.groups.items():
            self.groups[length] = (multipliers[: max(n for n, _, _ in sizes.values())], sizes)

    def search(self, raw: bytes) -> list[tuple[int, int]]:
        """Items that the text contains, with the number of their shingles found in it."""
        words = raw.split()
        hashes = word_hashes(words)
        candidates: set[int] = set()
        for length, (a, sizes) in self.groups.items():
            if length > len(words):
                continue
            for upper, minima in _windows(shingle_hashes(hashes, length), sorted(sizes), a):
                n, seen, where = sizes[upper]
                hit, at = np.nonzero(seen[np.arange(n)[:, None], minima[:n] >> np.uint64(48)])
                for i, value in zip(hit.tolist(), minima[hit, at].tolist()):
                    candidates.update(where.get((i, value), ()))
        found, sets = [], {}
        for at in sorted(candidates):
            _, length, own, _ = self.items[at]
            if length not in sets:
                sets[length] = shingles(words, length)
            n = len(own & sets[length])
            if n >= self.threshold * len(own) - 1e-9:
                found.append((at, n))
        return found


def _least_of(columns: np.ndarray, m: int) -> np.ndarray:
    """Minimum over every ``m`` neighbouring columns; the last group may be short."""
    out = columns[:, ::m].copy()
    for j in range(1, m):
        part = columns[:, j::m]
        np.minimum(out[:, : part.shape[1]], part, out=out[:, : part.shape[1]])
    return out


def _windows(hashes: np.ndarray, uppers: list[int], a: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each upper size the minima of every hash function (rows) over windows of twice that size (columns).

    Upper sizes are 1, or 4 times a power of two, or 12 times one; each is put together from smaller ones.
    """
    if 1 in uppers:
        for start in range(0, len(hashes), SPAN):
            yield 1, hashes[None, start : start + SPAN] * a[:, None]
    if uppers[-1] == 1:
        return
    span = max(SPAN, 2 * uppers[-1])
    for start in range(0, len(hashes), span):
        part = hashes[start : start + span + 2 * uppers[-1]]
        n = -(-len(part) // 4)
        padded = np.concatenate([part, np.repeat(part[-1:], 4 * n - len(part))]).reshape(n, 4).T.copy()
        steps = padded[0][None, :] * a[:, None]
        for row in padded[1:]:
            np.minimum(steps, row[None, :] * a[:, None], out=steps)
        twos, threes, u = steps, None, 4
        while u <= uppers[-1]:
            for size, least in ((u, twos), (3 * u // 2, threes)):
                if size in uppers and least is not None:
                    yield size, np.minimum(least[:, :-1], least[:, 1:]) if least.shape[1] > 1 else least
            threes = _least_of(threes, 2) if threes is not None else _least_of(steps, 3) if u == 4 else None
            twos, u = _least_of(twos, 2), 2 * u


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, bytes]]]:
    """The items in blocks of bounded count and size, fetched one partition at a time."""
    block, size = [], 0
    for key, raw in items.select(F.col(item_col), text_bytes(text_col)).toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or size + len(raw) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((key, bytes(raw)))
        size += len(raw)
    if block:
        yield block


def find_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", k: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL,
) -> DataFrame:
    """Rows ``(doc, item, n_shingles, n_found, containment)`` for every item of which a document holds ``threshold``.

    Containment is the share of the item's distinct runs of ``k`` words that occur in the document; items of fewer
    than ``k`` words count as one run. Null and wordless texts and items match nothing; repeated rows on either side
    give repeated pairs; null ids are carried along; other columns are not read. Empty tables give no rows.
    Documents are never shuffled: each pass takes a bounded block of items to the documents.
    """
    slim = docs.select(F.col(id_col).alias("doc"), text_bytes(text_col).alias("_raw"))
    item_type = items.schema[item_col].dataType
    schema = T.StructType(
        [T.StructField("doc", slim.schema["doc"].dataType), T.StructField("item", item_type)]
        + [T.StructField(n, T.LongType(), False) for n in ("n_shingles", "n_found")]
        + [T.StructField("containment", T.DoubleType(), False)]
    )
    found = None
    for block in item_blocks(items, item_col, item_text_col):
        part = slim.mapInArrow(_finder(Shared(docs.sparkSession, block), k, threshold, recall, item_type), schema)
        found = part if found is None else found.unionAll(part)
    result = found if found is not None else docs.sparkSession.createDataFrame([], schema)
    return result.withColumnsRenamed({"doc": id_col, "item": item_col if item_col != id_col else f"item_{item_col}"})


_index: dict[tuple, ItemIndex] = {}


def _index_of(block, *rule) -> ItemIndex:
    """The index of a broadcast block; a worker keeps the last one."""
    take_turn(_index.clear)
    key = (block.name, *rule)
    if key not in _index:
        _index.clear()
        _index[key] = ItemIndex(block.value, *rule)
    return _index[key]


def _finder(block, k: int, threshold: float, recall: float, item_type: T.DataType):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_item = to_arrow_type(item_type)

    def run(parts):
        index = _index_of(block, k, threshold, recall)
        for batch in parts:
            out = pa.schema(
                [pa.field("doc", batch.schema.field("doc").type), pa.field("item", arrow_item)]
                + [pa.field(n, pa.int64(), False) for n in ("n_shingles", "n_found")]
                + [pa.field("containment", pa.float64(), False)]
            )
            hits = (
                (doc, index.items[at][0], len(index.items[at][2]), n, n / len(index.items[at][2]))
                for doc, raw in rows(batch, "doc", "_raw")
                for at, n in index.search(raw)
            )
            yield from batches(hits, out)

    return run


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    k: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text contains no item; same rules as ``find_items``."""
    kept = docs
    for block in item_blocks(items, item_col, item_text_col):
        kept = kept.mapInArrow(_keeper(Shared(docs.sparkSession, block), text_col, k, threshold, recall), docs.schema)
    return kept


def _keeper(block, text_col: str, k: int, threshold: float, recall: float):
    def run(parts):
        index = _index_of(block, k, threshold, recall)
        for batch in parts:
            texts = batch.column(batch.schema.names.index(text_col))
            clean = [not index.search((text.as_py() or "").encode("utf-8", "surrogatepass")) for text in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))
        pa.default_memory_pool().release_unused()

    return run
