"""Convolutional text classifier in numpy: hashed word embeddings, several filter widths, max pooling.

Fitted on all labelled texts, whole, and applied to every whole text, both in Spark tasks. Thresholds are calibrated
per language on labelled texts kept out of the fit; the language is guessed from the words of the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from pageloom.llm.words import Shared, batches, rows, take_turn, text_bytes
from pageloom.operators.blocks import drop_written, shuffles_dropped, written

#: Buckets and width of the embeddings; a word is the sum of its own bucket and those of its first letters.
BUCKETS, WIDTH = 1 << 15, 16
PREFIXES = (3, 4, 5)
#: Filter widths in words, filters of each.
SPANS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE = 10, 64, 0.05
#: One labelled text in this many is kept for calibration.
ASIDE = 4
#: Bytes of labelled texts that one task learns from between two meetings of the networks, on average.
SHARD_BYTES = 16 << 20
#: Score at which a text counts as toxic; thresholds of all languages are mapped to it.
DECISION = 0.7
#: Weight of a clean text rejected against a toxic one missed, when a threshold is chosen.
FALSE_ALARM = 1
#: Texts of each class that a language needs for a threshold of its own.
OWN_THRESHOLD = 20
#: Words of a text whose filter parts are looked at together; they fit a core's cache.
PART = 2_000
#: Words a worker remembers with their filter parts.
REMEMBERED = 120_000

#: Common words by language, for the guess only.
COMMON = {
    "en": "the of and to in is that it was for with on are this be",
    "de": "der die und das den von zu mit sich des nicht ein ist dem",
    "fr": "le les des et en du une que qui dans pour au sur par",
    "es": "el los que del las por con una su para se al lo como",
}

_WORD = re.compile(r"\w+")
_LANGUAGE = {w: i for i, words in enumerate(COMMON.values()) for w in words.split()}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def language(words: list[str]) -> int:
    """Index of the language with the most common words; one past the last if there are none."""
    seen = [_LANGUAGE[w] for w in words if w in _LANGUAGE]
    return int(np.bincount(seen).argmax()) if seen else len(COMMON)


#: Buckets of beginnings that were met, and the most of them that are kept.
_beginnings: dict[str, int] = {}
BEGINNINGS = 100_000


def features(word: str) -> list[int]:
    """Buckets of a word and of its beginnings."""
    out = [xxh3_64_intdigest(f"w{word}") % BUCKETS]
    for n in PREFIXES:
        if len(word) <= n:
            break
        begins = word[:n]
        bucket = _beginnings.get(begins)
        if bucket is None:
            if len(_beginnings) >= BEGINNINGS:
                _beginnings.clear()
            bucket = _beginnings[begins] = xxh3_64_intdigest(f"{n}{begins}") % BUCKETS
        out.append(bucket)
    return out


def _columns() -> list[tuple[int, int, int]]:
    """Blocks of the projection: first filter, shift in words, first column."""
    out, column = [], 0
    for at, span in enumerate(SPANS):
        for shift in range(span):
            out.append((at * FILTERS, shift, column))
            column += FILTERS
    return out


_BLOCKS = _columns()
#: Columns of the projection by shift: all filters, those of two words and more, and so on.
_BY_SHIFT = np.concatenate([np.arange(c, c + FILTERS) for _, c in sorted((shift, c) for _, shift, c in _BLOCKS)])


@dataclass
class Network:
    """Embeddings, filters, biases and the last layer; thresholds by guessed language."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(COMMON) + 1))
    scales: np.ndarray = field(default_factory=lambda: np.ones(len(COMMON) + 1))
    constant: float | None = None

    def project(self, words: list[str]) -> np.ndarray:
        """Filter parts of the words, by shift."""
        flat, starts = [], []
        for word in words:
            starts.append(len(flat))
            flat += features(word)
        return np.add.reduceat(self.embedding[flat], starts, axis=0) @ self.filters[:, _BY_SHIFT]

    def logit(self, projected: np.ndarray) -> float:
        """From the projections of all words of one text, in order."""
        if len(projected) == 0:
            return self.shift
        pooled = convolve(projected).max(axis=0)
        return float(np.maximum(pooled + self.bias, 0) @ self.out + self.shift)

    def score(self, logit: float, spoken: int) -> float:
        """Monotone in the logit; the language's threshold becomes ``DECISION``."""
        if self.constant is not None:
            return self.constant
        x = (logit - self.thresholds[spoken]) * self.scales[spoken] + np.log(DECISION / (1 - DECISION))
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def convolve(projected: np.ndarray) -> np.ndarray:
    """All filters at all positions of a text."""
    n, width = len(projected), len(SPANS) * FILTERS
    out = projected[:, :width].copy()
    column = width
    for shift in range(1, max(SPANS)):
        wide = width - FILTERS * shift
        out[: max(0, n - shift), width - wide :] += projected[shift:, column : column + wide]
        column += wide
    return out


def _numbered(texts: Iterable[list[str]], vocabulary: dict[str, int]) -> list[np.ndarray]:
    return [np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in t), np.int32, len(t)) for t in texts]


def _buckets(vocabulary: dict[str, int]) -> np.ndarray:
    """Buckets of the words in the order of their numbers, filled up with one that stays empty."""
    feats = np.full((len(vocabulary), 1 + len(PREFIXES)), BUCKETS, np.int32)
    for i, word in enumerate(vocabulary):
        f = features(word)
        feats[i, : len(f)] = f
    return feats


def _seen(ids: list[np.ndarray], feats: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Texts of each class by bucket."""
    seen = np.zeros((2, BUCKETS + 1))
    for i, y in zip(ids, labels):
        seen[int(y), np.unique(feats[np.unique(i)])] += 1
    return seen


def _begin(rng: np.random.Generator, seen: np.ndarray, n_clean: int, n_toxic: int) -> dict[str, np.ndarray]:
    """Start values of all parameters, and of their sums of squares under ``+`` and the name."""
    odds = np.log((seen[1] + 3) / (n_toxic + 6)) - np.log((seen[0] + 3) / (n_clean + 6))
    odds[BUCKETS] = 0

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.1, shape).astype(np.float32)

    emb = np.vstack([start(BUCKETS, WIDTH), np.zeros((1, WIDTH), np.float32)])
    emb[:, 0] = odds
    filters = start(WIDTH, FILTERS * sum(SPANS))
    filters[0] = np.abs(filters[0]) + 0.2
    n_filters = FILTERS * len(SPANS)
    bias, out, shift = np.full(n_filters, -0.2, np.float32), np.full(n_filters, 0.15, np.float32), np.full(1, -1.5, np.float32)
    values = {"emb": emb, "filters": filters, "bias": bias, "out": out, "shift": shift}
    return values | {f"+{name}": np.full(v.shape, 1e-2, np.float32) for name, v in values.items()}


def _descend(at_work: dict[str, np.ndarray], ids: list[np.ndarray], feats: np.ndarray, labels: np.ndarray, weight: np.ndarray, usable: list[int]) -> None:
    """One pass over the texts ``usable`` in their order, in place."""
    most = feats.shape[1]
    met, place = np.zeros(len(feats), bool), np.zeros(len(feats), np.int64)
    emb, filters, bias, out, shift = (at_work[name] for name in ("emb", "filters", "bias", "out", "shift"))
    for at in range(0, len(usable), BATCH):
        chosen = usable[at : at + BATCH]
        flat = np.concatenate([ids[i] for i in chosen])
        sizes = np.array([len(ids[i]) for i in chosen])
        starts = np.cumsum(sizes) - sizes
        met[flat] = True
        unique = np.flatnonzero(met)
        met[unique] = False
        place[unique] = np.arange(len(unique))
        back = place[flat]
        vectors = emb[feats[unique]].sum(axis=1)
        projected = vectors @ filters[:, _BY_SHIFT]
        pooled, where = np.empty((len(chosen), len(out)), np.float32), np.empty((len(chosen), len(out)), np.int64)
        for i, (start, size) in enumerate(zip(starts, sizes)):
            # one text at a time stays in a core's cache
            maps = convolve(projected[back[start : start + size]])
            where[i] = maps.argmax(axis=0)
            pooled[i] = maps[where[i], np.arange(len(out))]
        hidden = np.maximum(pooled + bias, 0)
        logit = np.clip(hidden @ out + shift, -30, 30)
        error = ((1 / (1 + np.exp(-logit)) - labels[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
        grad_hidden = error[:, None] * out * (hidden > 0)
        grad_projected = np.zeros((len(unique), filters.shape[1]), np.float32)
        for first, move, column in _BLOCKS:
            spot, grad = where[:, first : first + FILTERS], grad_hidden[:, first : first + FILTERS]
            valid = spot + move < sizes[:, None]
            target = back[np.minimum(starts[:, None] + spot + move, len(flat) - 1)]
            columns = np.broadcast_to(np.arange(column, column + FILTERS), spot.shape)
            np.add.at(grad_projected, (target[valid], columns[valid]), grad[valid])
        moved = np.nonzero(grad_projected.any(axis=1))[0]
        grad_vectors = grad_projected[moved] @ filters.T
        grad_filters = vectors[moved].T @ grad_projected[moved] + 1e-4 * filters
        buckets, spread = np.unique(feats[unique[moved]], return_inverse=True)
        grad_emb = np.zeros((len(buckets), WIDTH), np.float32)
        np.add.at(grad_emb, spread.reshape(-1), np.repeat(grad_vectors, most, axis=0))
        grad_emb[buckets == BUCKETS] = 0
        for name, grad in (("filters", grad_filters), ("bias", grad_hidden.sum(axis=0)), ("out", error @ hidden + 1e-4 * out), ("shift", error.sum())):
            at_work[f"+{name}"] += grad**2
            at_work[name] -= RATE * grad / np.sqrt(at_work[f"+{name}"])
        at_work["+emb"][buckets] += grad_emb**2
        emb[buckets] -= RATE * grad_emb / np.sqrt(at_work["+emb"][buckets])


def _network(values: dict[str, np.ndarray]) -> Network:
    return Network(values["emb"][:BUCKETS].copy(), values["filters"], values["bias"], values["out"], float(values["shift"][0]))


def _weights(labels: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    return np.where(labels == 1, n_clean / max(1, n_toxic), 1.0) ** 0.5


def train(texts: Iterable[list[str]], labels: np.ndarray, seed: int = 4) -> Network:
    """Fit by stochastic gradient descent; embeddings start from the labels' log odds in one direction.

    The texts are gone through once and kept as numbers of words, not as words.
    """
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    ids = _numbered(texts, vocabulary)
    feats = _buckets(vocabulary)
    del vocabulary
    n_toxic, n_clean = labels.sum(), (1 - labels).sum()
    values = _begin(rng, _seen(ids, feats, labels), n_clean, n_toxic)
    usable = [i for i in range(len(ids)) if len(ids[i])]
    for _ in range(EPOCHS):
        rng.shuffle(usable)
        _descend(values, ids, feats, labels, _weights(labels, n_clean, n_toxic), usable)
    return _network(values)


def _threshold(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The middle of the widest gap among the cuts that cost least, and a scale from its width."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    missed = np.concatenate([[0], np.cumsum(y)])
    alarms = np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    errors = missed + FALSE_ALARM * alarms
    best = np.nonzero(errors == errors[1:-1].min())[0] if len(x) > 1 else np.array([0])
    best = best[(best > 0) & (best < len(x))]
    if not len(best):
        return float(x.mean()), 1.0
    gap = x[best] - x[best - 1]
    widest = int(gap.argmax())
    return float((x[best[widest]] + x[best[widest] - 1]) / 2), float(np.clip(4 / max(gap[widest], 1e-3), 0.5, 4))


def _set_thresholds(network: Network, logits: np.ndarray, spoken: np.ndarray, labels: np.ndarray) -> Network:
    everywhere = _threshold(logits, labels)
    for k in range(len(COMMON) + 1):
        own = spoken == k
        enough = min((labels[own] == 1).sum(), (labels[own] == 0).sum()) >= OWN_THRESHOLD
        network.thresholds[k], network.scales[k] = _threshold(logits[own], labels[own]) if enough else everywhere
    return network


def calibrate(network: Network, texts: Iterable[list[str]], labels: np.ndarray) -> Network:
    """Thresholds by guessed language; languages with few texts of either class take the one of all texts."""
    found = [(network.logit(network.project(t)) if t else network.shift, language(t)) for t in texts]
    return _set_thresholds(network, np.array([x for x, _ in found]), np.array([k for _, k in found]), labels)


_SHARD = "sizes binary, words binary, feats binary, labels binary, spoken binary"


@dataclass
class Shard:
    """Labelled texts as numbers of words: those that are learned from, then those kept aside."""

    ids: list[np.ndarray]
    feats: np.ndarray
    labels: np.ndarray
    spoken: np.ndarray
    n_fit: int

    @staticmethod
    def of(batch: pa.RecordBatch, row: int) -> Shard:
        def array(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(batch.column(name)[row].as_buffer(), kind)

        sizes, labels = array("sizes", np.int32), array("labels", np.int8).astype(np.int64)
        ids = np.split(array("words", np.int32), np.cumsum(sizes, dtype=np.int64)[:-1])
        return Shard(ids, array("feats", np.int32).reshape(-1, 1 + len(PREFIXES)), labels, array("spoken", np.int8), len(sizes) - len(sizes) // ASIDE)

    def fit_part(self) -> tuple[list[np.ndarray], np.ndarray]:
        return self.ids[: self.n_fit], self.labels[: self.n_fit]


def _shards(batches_in: Iterable[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches_in:
        for row in range(batch.num_rows):
            yield Shard.of(batch, row)


def _pack(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a partition, in order, as one shard; of each ``ASIDE`` the last is kept aside."""
    vocabulary: dict[str, int] = {}
    fit, aside = ([], [], []), ([], [], [])
    kept = []
    at = 0
    for batch in found:
        for raw, y in rows(batch, "_raw", "_y"):
            words = words_of(raw.decode("utf-8", "replace"))
            if at % ASIDE == ASIDE - 1:
                # words that only these texts have are numbered after those of the fit
                kept.append("\n".join(words).encode())
                aside[1].append(y)
                aside[2].append(language(words))
            else:
                fit[0].extend(_numbered([words], vocabulary))
                fit[1].append(y)
                fit[2].append(len(COMMON))
            at += 1
    if not at:
        return
    aside[0].extend(_numbered((k.decode().split("\n") if k else [] for k in kept), vocabulary))
    ids, labels, spoken = (a + b for a, b in zip(fit, aside))
    sizes = np.array([len(i) for i in ids], np.int32)
    columns = [sizes, np.concatenate(ids), _buckets(vocabulary), np.array(labels, np.int8), np.array(spoken, np.int8)]
    yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=[c.split()[0] for c in _SHARD.split(", ")])


#: Sums travel in this many pieces, so that no task reads those of all others.
PIECES = 16
_SUMS = "piece int, n long, sums binary"


def _sums(n: int, *pieces: tuple[int, np.ndarray]) -> pa.RecordBatch:
    at, sums = zip(*pieces)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([n] * len(at), pa.int64()), pa.array([x.tobytes() for x in sums], pa.binary())], names=["piece", "n", "sums"])


def _added_up(rows_in: DataFrame) -> tuple[int, np.ndarray]:
    """The sum of rows ``(piece, n, sums)``: a task adds those of a piece one at a time, the driver gets a row for each."""

    def add(found):
        n, total = 0, {}
        for batch in found:
            for piece, count, raw in rows(batch, "piece", "n", "sums"):
                part = np.frombuffer(raw)
                n, total[piece] = n + count, part.copy() if piece not in total else total[piece] + part
        if total:
            yield _sums(n // len(total), *total.items())

    got = sorted(rows_in.repartitionById(PIECES, F.col("piece")).mapInArrow(add, _SUMS).collect())
    return (got[0][1], np.concatenate([np.frombuffer(r[2]) for r in got])) if got else (0, np.zeros(0))


def _count_classes(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by class, in the fit and aside, and by class and bucket in the fit."""
    total, n = np.zeros(4 + 2 * (BUCKETS + 1)), 0
    for shard in _shards(found):
        ids, labels = shard.fit_part()
        total[:4] += np.concatenate([np.bincount(part, minlength=2) for part in (labels, shard.labels[shard.n_fit :])])
        total[4:] += _seen(ids, shard.feats, labels).reshape(-1)
        n += 1
    yield _sums(n, *enumerate(np.array_split(total, PIECES)))


def _learned(shared: Shared, n_clean: int, n_toxic: int, seed: int, epoch: int):
    """Each shard goes on from the shared values for one epoch; a task gives the sum of what its shards end with."""

    def run(found):
        n, total = 0, None
        for shard in _shards(found):
            ids, labels = shard.fit_part()
            rng = np.random.default_rng(seed)
            # the random numbers of the start and of the epochs before
            rng.normal(0, 0.1, (BUCKETS, WIDTH)), rng.normal(0, 0.1, (WIDTH, FILTERS * sum(SPANS)))
            usable = [i for i in range(len(ids)) if len(ids[i])]
            for _ in range(epoch + 1):
                rng.shuffle(usable)
            values = {name: v.copy() for name, v in shared.value.items()}
            _descend(values, ids, shard.feats, labels, _weights(labels, n_clean, n_toxic), usable)
            part = np.concatenate([v.reshape(-1) for v in values.values()]).astype(np.float64)
            n, total = n + 1, part if total is None else total + part
        if total is not None:
            yield _sums(n, *enumerate(np.array_split(total, PIECES)))

    return run


def _kept_aside(shared: Shared):
    """Logits, guessed languages and labels of the texts kept aside."""

    def run(found):
        network = shared.value
        embedding = np.vstack([network.embedding, np.zeros((1, WIDTH), np.float32)])
        for shard in _shards(found):
            logits = np.full(len(shard.ids) - shard.n_fit, network.shift)
            for i, words in enumerate(shard.ids[shard.n_fit :]):
                if len(words):
                    unique, back = np.unique(words, return_inverse=True)
                    logits[i] = network.logit((embedding[shard.feats[unique]].sum(axis=1) @ network.filters[:, _BY_SHIFT])[back])
            columns = [logits, shard.spoken[shard.n_fit :], shard.labels[shard.n_fit :].astype(np.int8)]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=["logits", "spoken", "labels"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", seed: int = 4) -> Network:
    """Fit and calibrate on all labelled texts, whole.

    ``labels`` holds the rows that may be learned from; rows with null id or label are left out, of an id labelled
    twice the higher label counts. Without texts of both classes, in the fit and in the quarter kept for calibration,
    every score is the share of toxic ones, 0 if only one class is known. It is kept below ``DECISION``: without a
    network no text is predicted toxic, and ``drop_toxic`` keeps all rows.

    The texts lie in shards of about ``SHARD_BYTES``, by digest of the id and in its order, as numbers of words. In an
    epoch each shard goes on from the same network, and the mean of what they end with is the network of the next; with
    one shard this is ``train``. A task holds a shard and a network, the driver a network and ten bytes for each text
    kept aside.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id is not null and _y is not null")
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).withColumn("_draw", F.xxhash64(F.col("_id").cast("string")))
    text = docs.select(F.col(id_col).alias("_key"), text_bytes(text_col).alias("_raw"))
    found = text.join(known, F.col("_key") == F.col("_id")).groupBy("_id").agg(F.min("_raw").alias("_raw"), F.first("_y").alias("_y"), F.first("_draw").alias("_draw"))
    with shuffles_dropped(spark):
        found = written(found.where("_y in (0, 1)").select("_draw", "_raw", "_y"), "labelled")
        n, size, toxic = found.agg(F.count("*"), F.sum(F.octet_length("_raw")), F.sum("_y")).first()
        n_shards = max(1, -(-(size or 0) // SHARD_BYTES))
        dealt = found.repartitionById(n_shards, F.pmod("_draw", F.lit(n_shards)).cast("int")).sortWithinPartitions("_draw", "_raw")
        shards = written(dealt.select("_raw", "_y").mapInArrow(_pack, _SHARD), "labelled-words")
        drop_written(found)
        _, counted = _added_up(shards.mapInArrow(_count_classes, _SUMS))
        if not n or counted[:4].min() == 0:
            drop_written(shards)
            empty = np.zeros((BUCKETS, WIDTH), np.float32)
            zero = np.zeros(FILTERS * len(SPANS), np.float32)
            share = toxic / n if n and 0 < toxic < n else 0.0
            below = min(share, float(np.nextafter(DECISION, 0)))
            return Network(empty, np.zeros((WIDTH, FILTERS * sum(SPANS)), np.float32), zero, zero, 0.0, constant=below)
        n_clean, n_toxic = int(counted[0]), int(counted[1])
        values = _begin(np.random.default_rng(seed), counted[4:].reshape(2, -1), n_clean, n_toxic)
        for epoch in range(EPOCHS):
            shared = Shared(spark, values)
            met, total = _added_up(shards.mapInArrow(_learned(shared, n_clean, n_toxic, seed, epoch), _SUMS))
            ends = np.cumsum([v.size for v in values.values()])
            parts = np.split((total / met).astype(np.float32), ends[:-1])
            values = {name: part.reshape(v.shape) for (name, v), part in zip(values.items(), parts)}
            shared.drop()
        network = _network(values)
        shared = Shared(spark, network)
        aside = shards.mapInArrow(_kept_aside(shared), "logits binary, spoken binary, labels binary").collect()
        shared.drop()
        drop_written(shards)
    logits, spoken, y = (np.concatenate([np.frombuffer(r[i], kind) for r in aside]) for i, kind in enumerate((np.float64, np.int8, np.int8)))
    return _set_thresholds(network, logits, spoken, y.astype(np.int64))


class Scorer:
    """Scores of whole texts; remembers the filter parts of words it has met."""

    def __init__(self, network: Network):
        self.network = network
        self.parts = np.zeros((0, network.filters.shape[1]), np.float32)
        self.place: dict[str, int] = {}

    def score(self, text: str) -> float:
        words = words_of(text)
        if not words or self.network.constant is not None:
            return self.network.score(self.network.shift, len(COMMON))
        spots = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(spots < 0)
        if len(missing):
            new = list(dict.fromkeys([words[i] for i in missing]))
            if len(self.place) + len(new) > REMEMBERED:
                self.place, new, missing = {}, list(dict.fromkeys(words)), np.arange(len(words))
            first = len(self.place)
            self.place.update(zip(new, range(first, first + len(new))))
            if len(self.parts) < len(self.place):
                grown = np.zeros((max(2 * len(self.parts), len(self.place), 10_000), self.parts.shape[1]), np.float32)
                grown[:first] = self.parts[:first]
                self.parts = grown
            for at in range(0, len(new), 20_000):
                self.parts[first + at : first + at + len(new[at : at + 20_000])] = self.network.project(new[at : at + 20_000])
            spots[missing] = [self.place[words[i]] for i in missing]
        best = np.full(len(SPANS) * FILTERS, -np.inf, np.float32)
        reach = max(SPANS) - 1
        for at in range(0, len(spots), PART):
            # windows start in this part and may reach into the next
            maps = convolve(self.parts[spots[at : at + PART + reach]])
            best = np.maximum(best, maps[:PART].max(axis=0))
        logit = float(np.maximum(best + self.network.bias, 0) @ self.network.out + self.network.shift)
        return self.network.score(logit, language(words))


_scorers: dict[str, Scorer] = {}


def _scorer(shared: Shared) -> Scorer:
    take_turn(_scorers.clear)
    if shared.name not in _scorers:
        _scorers.clear()
        _scorers[shared.name] = Scorer(shared.value)
    return _scorers[shared.name]


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, score, predicted)``, one per row of ``docs``: score from 0 to 1, predicted 1 from ``DECISION`` on.

    Null, empty and wordless texts get the score of a text without any word. Only the text decides. Repeated rows give
    repeated results, empty tables none; other columns are not read. Nothing is shuffled; the network is broadcast,
    its size is fixed.
    """
    slim = docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_raw"))
    schema = T.StructType([slim.schema["_id"], T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)])
    shared = Shared(docs.sparkSession, network)

    def run(parts):
        scorer = _scorer(shared)
        for batch in parts:
            out = pa.schema([batch.schema.field("_id"), pa.field("score", pa.float64(), False), pa.field("predicted", pa.int32(), False)])
            scored = ((key, scorer.score(raw.decode("utf-8", "replace"))) for key, raw in rows(batch, "_id", "_raw"))
            yield from batches(((key, s, int(s >= DECISION)) for key, s in scored), out)

    return slim.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def drop_toxic(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores below ``DECISION``; null texts count as empty."""
    shared = Shared(docs.sparkSession, network)

    def run(parts):
        scorer = _scorer(shared)
        for batch in parts:
            texts = batch.column(batch.schema.names.index(text_col))
            yield batch.filter(pa.array([scorer.score(t.as_py() or "") < DECISION for t in texts], pa.bool_()))
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves 1 on division by 3: these labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
