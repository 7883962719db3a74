"""Topics by variational Bayes over Spark tables: nothing of the size of the vocabulary reaches the driver.

Terms are numbered in a table, their weights in the topics are a table too. In every round each block of documents meets
the weights of its terms, and tasks fit the documents side by side in numpy; what they expect of each term is
added up by term and makes the next weights. The driver holds k numbers per round and the bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators.blocks import Blocks, Held, drop_written, shuffles_dropped, written
from pageloom.operators.corpus import MAX_SHARE, MIN_DOCS
from pageloom.operators.numbering import numbered

FIT_ROUNDS, FIT_CHANGE = 60, 1e-4
#: Pairs that are fitted at a time, so that they and their topics fit a core's cache, and pairs whose documents are put in order of size.
PLACES, TOGETHER = 16_000, 250_000


def digamma(x: np.ndarray) -> np.ndarray:
    """For positive values: six steps of the recurrence, then the asymptotic series."""
    x = np.asarray(x, dtype=float)
    less = 1 / x
    for i in range(1, 6):
        less += 1 / (x + i)
    x = x + 6
    y = 1 / (x * x)
    return np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132)))) - less


def log_gamma(x: np.ndarray) -> np.ndarray:
    x, less = np.array(x, dtype=float), np.zeros(np.shape(x))
    while (x < 6).any():
        low = x < 6
        less[low] += np.log(x[low])
        x[low] += 1
    y = 1 / (x * x)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) / x - less


def _side_by_side(sizes: np.ndarray) -> list[np.ndarray]:
    """Documents of like size, a few thousand pairs at a time, the shortest first; at most a quarter of the places stay empty, and eight of a document."""
    out, order, first = [], np.argsort(sizes, kind="stable"), 0
    ordered = sizes[order]
    while first < len(order):
        # the places of as many documents as end below the size that the first one allows
        last = int(np.searchsorted(ordered, max(ordered[first] * 4 // 3, ordered[first] + 8), "right"))
        last = min(last, first + max(1, PLACES // max(1, int(ordered[last - 1]))))
        out.append(order[first:last])
        first = last
    return out


def _fit_alike(counts: np.ndarray, topics: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the topics of documents in rows of one length, their start values of the last step, and the norms of the pairs.

    Places without a pair have counts and topics of 0. Products are small matrices, a document each.
    """
    n, k = len(counts), topics.shape[1]
    gamma = np.repeat((alpha + counts.sum(axis=1) / k)[:, None], k, axis=1)
    work, going, w_counts, w_topics = np.arange(n), np.ones(n, bool), counts, topics
    for _ in range(FIT_ROUNDS):
        old = gamma[work]
        theta = np.exp(digamma(old) - digamma(old.sum(axis=1))[:, None])
        norm = np.matmul(theta[:, None, :], w_topics)[:, 0]
        norm += 1e-300
        new = alpha + theta * np.matmul(w_topics, np.divide(w_counts, norm, out=norm)[:, :, None])[:, :, 0]
        gamma[work[going]] = new[going]
        going &= np.abs(new - old).mean(axis=1) >= FIT_CHANGE
        if not going.any():
            break
        if going.sum() < 0.8 * len(going):
            work, w_counts, w_topics = work[going], w_counts[going], w_topics[going]
            going = np.ones(len(work), bool)
    log_theta = digamma(gamma) - digamma(gamma.sum(axis=1))[:, None]
    return gamma, log_theta, np.matmul(np.exp(log_theta)[:, None, :], topics)[:, 0] + 1e-300


def fit_documents(counts: np.ndarray, topics: np.ndarray, sizes: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the topics of each document, expected counts of the pairs by topic, and the documents' part of the bound.

    The pairs of the documents lie one document after the other, ``sizes`` of each; ``topics`` has a row per topic with
    the exponent of the expected log weight for each pair. Documents of like size are fitted side by side, and one that
    has settled is left as it is.
    """
    k, starts = len(topics), np.cumsum(sizes) - sizes
    gamma, share, bound = np.empty((len(sizes), k)), np.empty(topics.shape), 0.0
    for docs in _side_by_side(sizes):
        places = np.arange(sizes[docs].max())
        held = places < sizes[docs, None]
        at = (starts[docs, None] + places)[held]
        c, t = np.zeros(held.shape), np.zeros((len(docs), k, len(places)))
        c[held] = counts[at]
        for j in range(k):
            t[:, j][held] = topics[j, at]
        gamma[docs], log_theta, last = _fit_alike(c, t, alpha)
        c[held] /= last[held]
        theta = np.exp(log_theta)
        for j in range(k):
            share[j, at] = (t[:, j] * (theta[:, j, None] * c))[held]
        bound += float(counts[at] @ np.log(last[held])) + ((alpha - gamma[docs]) * log_theta).sum()
    total = gamma.sum(axis=1)
    bound += (log_gamma(gamma) - log_gamma(alpha)).sum() + (log_gamma(k * alpha) - log_gamma(total)).sum()
    return gamma, share, float(bound)


def term_numbers(counts: DataFrame, n_docs: int) -> DataFrame:
    """(term, id) of the terms within the document frequency bounds of ``counts`` (doc, term, tf), one row per pair."""
    known = counts.groupBy("term").agg(F.count("*").alias("df")).where(f"df >= {MIN_DOCS} and df <= {MAX_SHARE} * {n_docs}")
    return numbered(known.select("term"), "term", name="id")


def _columns(k: int) -> list[str]:
    return [f"f{i}" for i in range(k)]


def start_weights(terms: DataFrame, k: int, seed: int) -> DataFrame:
    """Seeded positive weights of every term, from a hash of the term."""
    return terms.select("id", *[(1 + F.pmod(F.xxhash64("term", F.lit(i), F.lit(seed)), F.lit(1000)) / 1000.0).alias(c) for i, c in enumerate(_columns(k))])


def _expected(k: int, alpha: float, totals: list[float]):
    """A block's documents to expected counts by term; the row of kind 2 has their part of the bound."""

    def fit(held: Held) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base = digamma(np.array(totals))
        topics = np.ascontiguousarray(np.exp(digamma(held.factors) - base).T)
        sums, bound = np.zeros(topics.shape), 0.0
        for docs, pairs in held.parts(TOGETHER):
            at = held.at[pairs]
            _, share, part = fit_documents(held.amounts[pairs], topics[:, at], held.sizes[docs], alpha)
            bound += part
            for j in range(k):
                np.add.at(sums[j], at, share[j])
        n = len(held.ids)
        return np.append(np.zeros(n, int), 2), np.append(held.ids, 0), np.vstack([sums.T, np.full(k, bound / k)])

    return fit


def _topic_bound(weights: DataFrame, k: int, eta: float, totals: list[float], n_terms: int) -> float:
    """The topics' part of the bound; each batch of terms gives one number."""

    def run(found):
        base = digamma(np.array(totals))
        for batch in found:
            w = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, k + 1)])
            part = ((eta - w) * (digamma(w) - base) + log_gamma(w) - log_gamma(eta)).sum() if len(w) else 0.0
            yield pa.RecordBatch.from_arrays([pa.array([float(part)])], names=["part"])

    part = weights.mapInArrow(run, "part double").agg(F.sum("part")).first()[0] or 0.0
    return part + float((log_gamma(n_terms * eta) - log_gamma(np.array(totals))).sum())


def fit_topics(counts: DataFrame, terms: DataFrame, k: int, rounds: int, seed: int, bound: bool = False) -> tuple[DataFrame, list[float]]:
    """(id, f0 ...): weights of the numbered terms in k topics, and the bound of each round if asked for, which never falls.

    ``counts`` has (doc, id, tf). Both priors are 1 / k. Equal seeds give equal topics but for the order in which
    sums of doubles are formed.
    """
    names, prior = _columns(k), 1.0 / k
    with shuffles_dropped(counts.sparkSession):
        n_terms, bounds = terms.count(), []
        kept = written(start_weights(terms, k, seed), "lda-weights")
        if not n_terms:
            return kept, bounds
        blocks = Blocks(counts.select("doc", "id", F.col("tf").alias("amount")))
        weights = kept
        for _ in range(rounds):
            totals = list(weights.agg(*[F.sum(c) for c in names]).first())
            summed = written(blocks.meet(weights, k, _expected(k, prior, totals)), "lda-weights")
            if bound:
                of_docs = summed.where("kind = 2").select(sum(F.col(c) for c in names)).first()
                bounds.append((of_docs[0] if of_docs else 0.0) + _topic_bound(weights, k, prior, totals, n_terms))
            drop_written(kept)
            kept, weights = summed, summed.where("kind = 0").select("id", *[(F.col(c) + prior).alias(c) for c in names])
        blocks.drop()
    return weights, bounds
