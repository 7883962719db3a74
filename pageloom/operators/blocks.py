"""Documents in blocks that meet the factors of their terms: what a round of a topic model moves between machines.

A document is one row with the numbers of its terms and their amounts. Documents lie in blocks of a bounded number of
pairs; a block needs the factors of each of its terms once, however many of its documents hold the term, and gives one
sum for it. So a round moves the documents once and a row for each different term of a block, not one for each pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators.inrow import let
from pageloom.session import work_path

#: Most pairs of a document and a term in a block, on average: this and the sums of a block's terms lie in a task's memory.
PAIRS = 3_000_000


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once, packed, to the shared folder and read from there; ``drop_written`` removes them."""
    path = work_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


def drop_written(rows: DataFrame) -> None:
    """Remove the folder that ``written`` made for these rows."""
    spark = rows.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class shuffles_dropped:
    """While it lasts, the shuffle files of a query go when it ends, so rounds do not add up on the disks."""

    NAME = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark):
        self.conf = spark.conf

    def __enter__(self):
        self.before = self.conf.get(self.NAME, None)
        self.conf.set(self.NAME, "true")

    def __exit__(self, *_):
        if self.before is None:
            self.conf.unset(self.NAME)
        else:
            self.conf.set(self.NAME, self.before)


@dataclass
class Held:
    """A block: its term ids in order with their factors, its documents with places of their terms, and rows of documents."""

    ids: np.ndarray
    factors: np.ndarray
    docs: np.ndarray
    sizes: np.ndarray
    at: np.ndarray
    amounts: np.ndarray
    own: np.ndarray

    def parts(self, most: int = 16_000) -> Iterator[tuple[slice, slice]]:
        """Documents and their pairs, a few at a time."""
        ends = np.cumsum(self.sizes)
        first = 0
        while first < len(ends):
            begin = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, begin + most, "right")))
            yield slice(first, last), slice(int(begin), int(ends[last - 1]))
            first = last


def _hold(found: Iterator[pa.RecordBatch], k: int) -> Held | None:
    ids, factors, docs, sizes, terms, amounts, doc_ids, own = ([] for _ in range(8))
    for batch in found:
        kind = batch.column("kind").to_numpy()
        for which, to, rows_to in ((0, ids, factors), (1, doc_ids, own)):
            part = batch.filter(pa.array(kind == which))
            if part.num_rows:
                to.append(part.column("id").to_numpy())
                rows_to.append(np.column_stack([part.column(f"f{i}").to_numpy() for i in range(k)]))
        part = batch.filter(pa.array(kind == 2))
        if part.num_rows:
            docs.append(part.column("id").to_numpy())
            sizes.append(part.column("ids").value_lengths().to_numpy().astype(np.int64))
            terms.append(part.column("ids").flatten().to_numpy())
            amounts.append(part.column("amounts").flatten().to_numpy())
    if not docs or not ids:
        return None
    all_ids, all_docs = np.concatenate(ids), np.concatenate(docs)
    order = np.argsort(all_ids)
    all_ids, all_factors = all_ids[order], np.concatenate(factors)[order]
    factors.clear()
    if own:
        order = np.argsort(np.concatenate(doc_ids))
        of_docs = np.concatenate(own)[order][np.searchsorted(np.concatenate(doc_ids)[order], all_docs)]
    else:
        of_docs = np.zeros((len(all_docs), 0))
    at = np.concatenate([np.searchsorted(all_ids, t).astype(np.int32) for t in terms])
    return Held(all_ids, all_factors, all_docs, np.concatenate(sizes), at, np.concatenate(amounts), of_docs)


class Blocks:
    """Documents of ``rows`` (doc, id, amount); ``doc`` of any type, those of one ``doc`` are one document.

    ``docs`` has a row (doc, number, ids, amounts) per document, the amounts divided by their length as a vector with
    ``norm``. Rows with a null ``doc`` are left out of the blocks.
    """

    def __init__(self, rows: DataFrame, norm: bool = False):
        self.spark = rows.sparkSession
        pairs = rows.groupBy("doc").agg(F.collect_list(F.struct(F.col("id").cast("int").alias("id"), F.col("amount").cast("double").alias("amount"))).alias("x"))
        amounts = "x.amount"
        if norm:
            amounts = let("n", "sqrt(aggregate(x.amount, 0D, (a, v) -> a + v * v))", "transform(x.amount, v -> v / n)")
        self.docs = written(pairs.select("doc", F.monotonically_increasing_id().alias("number"), F.col("x.id").alias("ids"), F.expr(amounts).alias("amounts")), "blocks")
        self.known = self.docs.where("doc is not null")
        found = self.known.agg(F.sum(F.size("ids"))).first()[0] or 0
        self.n = max(self.spark.sparkContext.defaultParallelism, -(-found // PAIRS))
        self.block = F.pmod(F.xxhash64("number"), F.lit(self.n)).cast("int")
        wanted = self.known.select(self.block.alias("block"), F.explode("ids").alias("id")).distinct()
        self.wanted = written(wanted.groupBy("id").agg(F.collect_list("block").alias("blocks")), "blocks-wanted")

    def meet(self, factors: DataFrame, k: int, fit: Callable[[Held], tuple[np.ndarray, np.ndarray, np.ndarray]], own: DataFrame | None = None) -> DataFrame:
        """(kind, id, f0 ...): sums by term (kind 0), and rows of single documents (kind 1) or of nothing (kind 2), added up by kind and id.

        ``factors`` has (id, f0 ...) for the terms, ``own`` (number, f0 ...) for the documents. ``fit`` gives kinds, ids and rows for a block.
        """
        names = [f"f{i}" for i in range(k)]
        # empty, not null: on its way to Python a batch would go through all its null lists again with every row
        none = [F.array().cast("array<int>").alias("ids"), F.array().cast("array<double>").alias("amounts")]
        sent = factors.join(self.wanted, "id").select(F.explode("blocks").alias("block"), F.lit(0).alias("kind"), F.col("id").cast("long").alias("id"), *names, *none)
        docs = self.known.select(self.block.alias("block"), F.lit(2).alias("kind"), F.col("number").alias("id"), *[F.lit(None).cast("double").alias(c) for c in names], "ids", "amounts")
        rows = sent.unionAll(docs)
        if own is not None:
            rows = rows.unionAll(own.select(self.block.alias("block"), F.lit(1).alias("kind"), F.col("number").alias("id"), *names, *none))
        out = pa.schema([("kind", pa.int32()), ("id", pa.int64()), *[(c, pa.float64()) for c in names]])

        def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = _hold(found, k)
            if held is None:
                return
            kinds, ids, table = fit(held)
            for at in range(0, len(ids), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(kinds[part], pa.int32()), pa.array(ids[part], pa.int64()), *[pa.array(table[part, i]) for i in range(k)]], schema=out)

        # one block is one partition
        met = rows.repartitionById(self.n, F.col("block")).drop("block").mapInArrow(run, "kind int, id long, " + ", ".join(f"{c} double" for c in names))
        return met.groupBy("kind", "id").agg(*[F.sum(c).alias(c) for c in names])

    def drop(self) -> None:
        drop_written(self.wanted)
        drop_written(self.docs)
