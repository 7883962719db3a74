"""A folder of rows keyed by digest: appended, pinned, looked up through an index, and compacted under readers.

Rows lie below ``data`` in one folder per append, in buckets of the digest and sorted by it. An append or a compaction
becomes visible by one rename of a small entry in ``log`` that names the folders it adds and removes. What is live is
all that was added and not removed, so entries need no order and writers never meet: rows appended during a
compaction stay, since it removes only the folders it has read. Readers resolve the live folders once and keep them;
removed folders stay on disk until `vacuum`.

``index`` has a row for every file: its least and greatest digest and a bitmap of its digests, so that a look-up opens
the files that can hold one of its digests and no others.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pageloom.operators.blocks import shuffles_dropped

INDEX = "file string, bucket string, least string, greatest string, n long, bits binary, part string"
ENTRY = "add array<string>, remove array<string>"
#: Bits of the bitmap of a file; two of them are set for each digest.
BITS = 32768
#: Files a look-up names one by one; more of them are read as the whole folder, with the same rows.
NAMED_FILES = 10_000


def _bit(key: str, half: int) -> str:
    """One of two bit numbers of a digest, from different parts of its hash."""
    return f"cast(pmod(shiftrightunsigned(xxhash64({key}), {16 * half}), {BITS}) as int)"


class KeyedLog:
    """The folder ``path`` of rows of ``schema``; ``key`` is a hexadecimal digest, its first ``digits`` name the bucket."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "digest", digits: int = 2, file_rows: int = 20_000):
        self.spark, self.path, self.schema, self.key, self.digits, self.file_rows = spark, path, schema, key, digits, file_rows

    def _folder(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _bucket(self):
        # the letter keeps digits from being read back as numbers
        return F.concat(F.lit("b"), F.substring(self.key, 1, self.digits))

    # --- versions

    def _publish(self, name: str, add: list[str], remove: list[str]) -> None:
        folder, fs = self._folder("log")
        fs.mkdirs(folder)
        draft = self._folder(f"log/.{name}-{uuid.uuid4().hex}")[0]
        out = fs.create(draft)
        out.write(bytearray(json.dumps({"add": add, "remove": remove}).encode()))
        out.close()
        if not fs.rename(draft, self._folder(f"log/{name}.json")[0]):
            raise OSError(f"entry {name} was not published")

    def _entries(self) -> tuple[set[str], set[str]]:
        folder, fs = self._folder("log")
        if not fs.exists(folder):
            return set(), set()
        # one short row for each append and compaction
        found = self.spark.read.schema(ENTRY).json(f"{self.path}/log").collect()
        return {f for r in found for f in r["add"]}, {f for r in found for f in r["remove"]}

    def live(self) -> list[str]:
        """The folders that count now."""
        added, removed = self._entries()
        return sorted(added - removed)

    def has(self, name: str) -> bool:
        """Whether an append of that name is published."""
        path, fs = self._folder(f"log/{name}.json")
        return fs.exists(path)

    # --- rows

    def append(self, rows: DataFrame, name: str | None = None) -> None:
        """Add rows; an append of a name that is published already does nothing."""
        name = name or uuid.uuid4().hex
        if not self.has(name):
            self._publish(name, [self._write(rows)], [])

    def _write(self, rows: DataFrame) -> str:
        part = uuid.uuid4().hex
        data = f"{self.path}/data/part={part}"
        dealt = rows.select(*self.schema.names).withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        with shuffles_dropped(rows.sparkSession):
            (
                dealt.sortWithinPartitions("bucket", self.key)
                .write.option("maxRecordsPerFile", self.file_rows)
                .option("compression", "zstd")
                .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
                # without it a filter takes 1 MiB, however few rows its file has
                .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(self.file_rows))
                .partitionBy("bucket")
                .parquet(data)
            )
        written = self.spark.read.schema(StructType([self.schema[self.key], StructField("bucket", StringType())])).parquet(data)
        bits = F.explode(F.array(*[F.expr(_bit("key", h)) for h in (0, 1)]))
        # positions count from 1 in the bitmap functions
        files = (
            written.select(F.col("_metadata.file_path").alias("file"), "bucket", F.col(self.key).alias("key"))
            .select("file", "bucket", "key", bits.alias("bit"))
            .groupBy("file", "bucket")
            .agg(F.min("key").alias("least"), F.max("key").alias("greatest"), (F.count("*") / 2).cast("long").alias("n"), F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("bits"))
        )
        files.coalesce(1).write.parquet(f"{self.path}/index/part={part}")
        return part

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        typed = StructType([*self.schema.fields, StructField("part", StringType()), StructField("bucket", StringType())])
        return self.spark.read.schema(typed).option("basePath", f"{self.path}/data").parquet(*paths).select(*self.schema.names)

    def read(self) -> DataFrame:
        """All rows that are live now; later appends, compactions and clean-ups change nothing in the result."""
        return self._read([f"{self.path}/data/part={p}" for p in self.live()])

    def keys(self) -> DataFrame:
        return self.read().select(self.key)

    def index(self) -> DataFrame:
        """A row for each live file."""
        parts = self.live()
        if not parts:
            return self.spark.createDataFrame([], INDEX)
        return self.spark.read.schema(INDEX).option("basePath", f"{self.path}/index").parquet(*[f"{self.path}/index/part={p}" for p in parts])

    def files_for(self, keys: DataFrame) -> list[str] | None:
        """The files that can hold one of the keys; none if they are too many to be named."""
        wanted = keys.select(F.col(self.key).alias("key")).where("key is not null").distinct().withColumn("bucket", F.concat(F.lit("b"), F.substring("key", 1, self.digits)))
        wanted = wanted.withColumns({f"b{h}": F.expr(_bit("key", h)) for h in (0, 1)})
        # a bitmap holds bit p in byte p / 8
        held = " and ".join(f"shiftright(cast(conv(hex(substring(bits, b{h} div 8 + 1, 1)), 16, 10) as int), b{h} % 8) & 1 = 1" for h in (0, 1))
        found = wanted.join(self.index().drop("part"), "bucket").where(f"key between least and greatest and {held}").select("file").distinct()
        names = [r["file"] for r in found.limit(NAMED_FILES + 1).collect()]
        return None if len(names) > NAMED_FILES else sorted(names)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The live rows of the keys in column ``key``; files that can hold none of them are not opened."""
        files = self.files_for(keys)
        found = self.read() if files is None else self._read(files)
        return found.join(keys.select(self.key).distinct(), self.key, "left_semi")

    # --- upkeep

    def compact(self, reduce=lambda rows: rows) -> None:
        """Rewrite the live rows, reduced, into one folder. Rows appended meanwhile are not touched."""
        parts = self.live()
        if parts:
            rows = reduce(self._read([f"{self.path}/data/part={p}" for p in parts]))
            self._publish(f"compact-{uuid.uuid4().hex}", [self._write(rows)], parts)

    def vacuum(self, hours: float = 24.0) -> int:
        """Delete folders that are not live and were written more than ``hours`` ago; readers that began later are safe."""
        live, before, gone = set(self.live()), time.time() * 1000 - hours * 3_600_000, 0
        for kind in ("data", "index"):
            folder, fs = self._folder(kind)
            for found in fs.listStatus(folder) if fs.exists(folder) else ():
                path = found.getPath()
                if path.getName().removeprefix("part=") not in live and found.getModificationTime() <= before:
                    gone += bool(fs.delete(path, True))
        return gone
