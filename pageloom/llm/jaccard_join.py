"""Similarity join on word n-grams: MinHash banding, a shuffle on band hashes, verification on full n-gram sets.

Equal texts are one node. Nodes that share a band hash are tied to the least node of that band, never to each other,
and the ties make candidate groups. Each node's full n-gram set goes to its group once per block of the group; the
tasks compare all nodes of two blocks with each other and return a number of links per node and a spanning forest,
not pairs. So every link is counted, whatever the size of a group, and no row stands for a pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.graph import components
from pageloom.llm.words import batches, combine, packed, rows, shingle_hashes, take_turn, text_bytes, word_hashes
from pageloom.session import ensure_checkpoint_dir

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99999
#: Hash functions per text at most; more rows per band mean fewer false candidates.
MOST_HASHES = 100
#: A block of a group holds about this many nodes and n-grams.
BLOCK_NODES = 1_000
BLOCK_SHINGLES = 1_000_000


def bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows whose bands still reach the recall at the threshold within ``most``."""
    best = (min(most, math.ceil(math.log(1 - recall) / math.log(1 - threshold))), 1)
    for n_rows in range(2, most + 1):
        n_bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**n_rows))
        if n_bands * n_rows > most:
            break
        best = (n_bands, n_rows)
    return best


class Signer:
    """Band hashes of n-gram sets."""

    def __init__(self, n_bands: int, n_rows: int):
        self.n_bands, self.n_rows = n_bands, n_rows
        rng = np.random.default_rng(9)
        self.a = rng.integers(0, 1 << 63, n_bands * n_rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), 1024):
            np.minimum(least, (shingles[None, at : at + 1024] * self.a[:, None]).min(axis=1), out=least)
        return least

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        """One 64-bit name per band, different bands never sharing a name by design."""
        least = self.minima(shingles).reshape(self.n_bands, self.n_rows)
        out = np.arange(self.n_bands, dtype=np.uint64)
        for r in range(self.n_rows):
            out = combine(out, least[:, r])
        return out


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, n_bands: int, n_rows: int) -> DataFrame:
    """Rows ``(doc, node, n_shingles, bands)``: node is the digest of the text, bands is empty without words."""
    slim = docs.select(F.col(id_col).alias("doc"), text_bytes(text_col).alias("_raw"))
    slim = slim.withColumn("node", F.unhex(F.md5("_raw")))
    schema = T.StructType(
        [
            slim.schema["doc"],
            T.StructField("node", T.BinaryType(), False),
            T.StructField("n_shingles", T.IntegerType(), False),
            T.StructField("bands", T.ArrayType(T.LongType(), False), False),
        ]
    )

    def run(parts):
        take_turn()
        signer = Signer(n_bands, n_rows)
        for batch in parts:
            out = pa.schema(
                [
                    batch.schema.field("doc"),
                    pa.field("node", pa.binary(), False),
                    pa.field("n_shingles", pa.int32(), False),
                    pa.field("bands", pa.list_(pa.field("element", pa.int64(), False)), False),
                ]
            )

            def signed(batch=batch):
                for doc, raw, node in rows(batch, "doc", "_raw", "node"):
                    shingles = shingle_hashes(word_hashes(raw.split()), k)
                    if len(shingles):
                        yield doc, node, len(shingles), signer.bands(shingles).view(np.int64)
                    else:
                        yield doc, node, 0, []

            yield from batches(signed(), out)

    return slim.mapInArrow(run, schema)


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` of all nodes that share a band with another one."""
    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("band", "hub")
    return components(banded.join(shared, "band").select(F.col("node").alias("a"), F.col("hub").alias("b")))


def _spread(placed: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row per node and pair of blocks it takes part in; a group has as many blocks as its size asks for."""
    sized = placed.join(nodes.select("node", "n_shingles", "copies"), "node")
    size = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")).where("n > 1")
    blocks = size.select("root", F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (
        sized.join(blocks, "root")
        .withColumn("own", own)
        .select("node", "copies", "root", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("node", "copies", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )


def _counted(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, copies: np.ndarray, threshold: float):
    """Links between the nodes ``left`` and ``right``: per node links, links weighted by copies, and a root."""
    n = len(sets)
    links, weighted, root = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # n-grams of one node cannot be shared
    owner, column = owner[count[column] > 1], column[count[column] > 1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1] if len(column) else column
    width = int(column[-1]) + 1 if len(column) else 0
    step = max(1, (16 << 20) // max(1, n))
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    same = left is right
    for first in range(0, width, step):
        a, b = np.searchsorted(column, [first, first + step])
        dense = np.zeros((n, min(step, width - first)), dtype=np.float32)
        dense[owner[a:b], column[a:b] - first] = 1
        common += dense[left] @ dense[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    linked = common >= threshold * union - 1e-6
    if same:
        np.fill_diagonal(linked, False)
    links[left] += linked.sum(axis=1)
    weighted[left] += linked @ copies[right]
    if not same:
        links[right] += linked.sum(axis=0)
        weighted[right] += linked.T @ copies[left]
    # each row meets its partners' trees once
    for r in range(len(left)):
        partners = np.nonzero(linked[r])[0]
        if len(partners):
            top = find(left[r])
            for c in right[partners[np.unique(root[right[partners]], return_index=True)[1]]]:
                other = find(c)
                if other != top:
                    low, high = min(top, other), max(top, other)
                    root[high] = low
                    top = low
    return links, weighted, np.array([find(x) for x in range(n)])


def _verifier(k: int, threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        nodes = table.column("node").to_pylist()
        first = {node: at for at, node in reversed(list(enumerate(nodes)))}
        keep = sorted(first.values())
        own = table.column("own").to_pylist()
        raw = table.column("shingles")
        sets = [np.frombuffer(raw[at].as_py(), np.uint64) for at in keep]
        own = np.array([own[at] for at in keep])
        copies = np.array([table.column("copies")[at].as_py() for at in keep], dtype=np.int64)
        left = np.nonzero(own == i)[0]
        right = left if i == j else np.nonzero(own == j)[0]
        links, weighted, root = _counted(sets, left, right, copies, threshold)
        kept = [nodes[at] for at in keep]
        return pa.table(
            {
                "node": pa.array(kept, pa.binary()),
                "root": pa.array([kept[r] for r in root], pa.binary()),
                "links": pa.array(links, pa.int64()),
                "weighted": pa.array(weighted, pa.int64()),
            }
        )

    return run


def _with_sets(docs: DataFrame, chosen: DataFrame, text_col: str, k: int) -> DataFrame:
    """The n-gram sets (sorted 64-bit names) of the chosen nodes, one row each however many documents have the text."""
    slim = docs.select(text_bytes(text_col).alias("_raw"))
    slim = slim.withColumn("node", F.unhex(F.md5("_raw")))
    # copies are combined before the shuffle, so a text leaves each task once
    texts = packed(slim, "_raw").groupBy("node").agg(F.first("_raw").alias("_raw"))
    picked = texts.join(chosen.select("node"), "node", "left_semi")
    schema = T.StructType([T.StructField("node", T.BinaryType(), False), T.StructField("shingles", T.BinaryType(), False)])

    def run(parts):
        out = pa.schema([pa.field("node", pa.binary(), False), pa.field("shingles", pa.binary(), False)])
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in parts:
            yield from batches(
                ((node, np.unique(shingle_hashes(word_hashes(unpack(raw).split()), k)).tobytes()) for node, raw in rows(batch, "node", "_raw")), out
            )

    return picked.select("node", "_raw").mapInArrow(run, schema)


def similarity_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``docs``: ``(id, class_id, n_links, n_text_links, n_copies, node, class_node)``.

    Two texts are linked if the Jaccard similarity of their sets of ``k``-word runs is at least ``threshold``; a text
    of fewer words counts as one run. ``class_id`` is the least id of all documents connected by links or equal texts.
    ``n_copies`` counts the documents with the same text, ``n_text_links`` the different texts linked with it,
    ``n_links`` the other documents linked with it, copies included. ``node`` is the text's digest, ``class_node`` the
    least of the class: it names the class where ids are null or stand on texts of several classes, which then have
    the same ``class_id``. It is null for texts without runs.

    Null, empty and blank texts have no runs: each is a class of its own with no link and one copy. Repeated rows are
    copies of each other; null ids are the least id only where no other is in the class. Other columns are not read.
    Empty tables give no rows. Pairs whose bands never meet are missed with a chance of ``1 - recall`` at the
    threshold and less above; a link once met is verified on full sets, so no false link is reported.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    n_bands, n_rows = bands(threshold, recall)
    signed = signatures(docs, id_col, text_col, k, n_bands, n_rows).checkpoint()
    worded = signed.where("n_shingles > 0")
    nodes = worded.groupBy("node").agg(
        F.min("doc").alias("first_doc"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")
    )
    placed = candidate_groups(nodes)
    spread = _spread(placed, nodes).checkpoint()
    sets = _with_sets(docs, spread.select("node").distinct(), text_col, k)
    verified = (
        spread.join(sets, "node")
        .groupBy("root", "i", "j")
        .applyInArrow(_verifier(k, threshold), "node binary, root binary, links long, weighted long")
        .checkpoint()
    )
    counts = verified.groupBy("node").agg(F.sum("links").alias("n_text_links"), F.sum("weighted").alias("weighted"))
    classes = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    firsts = nodes.select("node", "first_doc", "copies")
    linked = firsts.join(classes, "node", "left").join(counts, "node", "left")
    group = F.coalesce("root", "node")
    least = linked.groupBy(group.alias("group")).agg(F.min("first_doc").alias("class_id"))
    known = linked.join(least, group == F.col("group")).select(
        "node",
        "class_id",
        F.col("group").alias("class_node"),
        F.col("copies").alias("n_copies"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        (F.coalesce("weighted", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    with_class = worded.select("doc", "node").join(known, "node")
    wordless = signed.where("n_shingles = 0").select(
        "doc", "node", F.col("doc").alias("class_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_text_links"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("binary").alias("class_node")
    )
    columns = ["doc", "class_id", "n_links", "n_text_links", "n_copies", "node", "class_node"]
    return with_class.select(columns).unionAll(wordless.select(columns)).withColumnRenamed("doc", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """The rows of ``docs`` without those that are like another: of each class the text with the least id stays.

    Wordless texts all stay. Of repeated rows with the same id and text one stays. Null ids come last, and of several
    texts with the least id the one with the least digest stays. Columns are unchanged.
    """
    found = similarity_classes(docs, id_col, text_col, **rule)
    class_rows = found.where("class_node is not null").select("class_node", F.col("class_id").alias("_class"), F.col(id_col).alias("_doc"), F.col("node").alias("_node"))
    kept = class_rows.where(F.col("_doc").eqNullSafe(F.col("_class"))).groupBy("class_node", "_class").agg(F.min("_node").alias("_node")).drop("class_node")
    # the input row travels as one value, so its columns may have any names
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        (~F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).alias("_blank"),
        F.unhex(F.md5(text_bytes(text_col))).alias("_text_node"),
    )
    match = (F.col("_id").eqNullSafe(F.col("_class"))) & (F.col("_text_node") == F.col("_node"))
    chosen = keyed.where("not _blank").join(kept, match).dropDuplicates(["_id", "_text_node"])
    return chosen.select("_row.*").unionAll(keyed.where("_blank").select("_row.*"))
