"""Phrase collocations of a corpus: Rabin-Karp fingerprints counted on Spark, frequent phrases cut from the text.

Prefix polynomials over the bytes give a fingerprint of every word, those over the word fingerprints one of every
n-gram. Lengths are counted one after the other: an n-gram goes to the shuffle only if both n-grams of one word less
inside it may be frequent, as no phrase is more frequent than its parts. What may be frequent is known from a bitmap
of fixed size: a bit for each frequent fingerprint. A fingerprint that meets another, or a full bitmap, lets more
n-grams through and loses none. The last count shuffles the fingerprints that may be frequent with a second, independent
one and a pointer to an occurrence; phrases that share the first differ in the second and stay apart. Only then are the
frequent phrases cut from the texts the pointers point at, where both fingerprints are checked against the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from pageloom.llm.sharding import with_running_totals
from pageloom.llm.words import Shared, batches, mix, rows, take_turn, text_bytes
from pageloom.session import ensure_checkpoint_dir

BASE, CHECK_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Bits left out of second fingerprints and of pointers: 96 bits name a phrase, 40 a text to look in.
CHECK_SPARE, SPARE = np.uint64(32), np.uint64(24)
#: Bits of the filter of frequent fingerprints: 8 MiB, whatever the input.
FILTER_BITS = 26
#: Bytes of text that are hashed at a time; longer texts are cut between words.
CHUNK_BYTES = 1 << 20
#: Fingerprints a task holds before it hands them to the shuffle.
HELD = 2 << 20

_BREAK, _BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
_breaks = np.zeros(256, bool)
_breaks[list(_BREAK)] = True
_cuts = _breaks.copy()
_cuts[list(_BLANK)] = True
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, as many as the longest chunk so far needed."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = _powers(self.base, n)
            self.down = _powers(pow(self.base, -1, 1 << 64), n)
        return self.up, self.down


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _prefixes(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=out[1:])
    return out


class Chunk:
    """Words of some whole texts, or of a part of one: bounds, piece and document of every word, fingerprints of n-grams.

    ``skip`` words at the start belong to the part before: n-grams that end in them are left out.
    """

    def __init__(self, data: bytes, starts: list[int], seeds: list[int], skip: int = 0):
        self.data, self.skip = data, skip
        codes = np.frombuffer(data, np.uint8)
        cut = np.ones(len(codes) + 2, bool)
        cut[1:-1] = _cuts[codes]
        edges = np.flatnonzero(cut[1:] != cut[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.piece = np.cumsum(_breaks[codes], dtype=np.int32)[self.start] if len(codes) else np.zeros(0, np.int32)
        self.doc = np.searchsorted(np.array(starts), self.start, side="right") - 1
        self.seed = np.array(seeds, np.uint64)[self.doc]
        self._codes = codes

    def fingerprints(self, powers: _Powers, longest: int) -> list[np.ndarray]:
        """For n = 1 to ``longest`` the fingerprint of the n words that begin at each word, as far as there are n left."""
        up, down = powers.take(len(self._codes) + 1)
        over = _prefixes(_BYTE_CODES[self._codes], up)
        word = mix((over[self.end] - over[self.start]) * down[self.start])
        over = _prefixes(word, up)
        out = []
        for n in range(1, longest + 1):
            m = max(0, len(word) - n + 1)
            out.append(mix((over[n : n + m] - over[:m]) * down[:m] ^ self.seed[:m]))
        return out

    def valid(self, n: int) -> np.ndarray:
        """Whether the n words from each word stand in one piece and end behind the skipped words."""
        m = max(0, len(self.start) - n + 1)
        ok = self.piece[n - 1 : n - 1 + m] == self.piece[:m]
        ok[: max(0, self.skip - n + 1)] = False
        return ok

    def phrase(self, i: int, n: int) -> bytes:
        return b" ".join(self.data[self.start[j] : self.end[j]] for j in range(i, i + n))


def _seed(lang: str) -> int:
    return xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _chunks(found: Iterable[pa.RecordBatch], longest: int) -> Iterator[tuple[Chunk, list[tuple]]]:
    """Chunks of the texts of ``(_text, _lang, _id)`` rows, each with the (lang, id, words before) of its documents."""
    held: list[bytes] = []
    about: list[tuple] = []
    size = 0

    def close():
        starts = np.cumsum([0] + [len(t) + 1 for t in held[:-1]]).tolist()
        return Chunk(b"\n".join(held), starts, [_seed(lang) for lang, _, _ in about]), list(about)

    for batch in found:
        for text, lang, key in rows(batch, "_text", "_lang", "_id"):
            text = text.lower()
            if len(text) > CHUNK_BYTES:
                yield from _parts(text, lang, key, longest)
                continue
            if held and size + len(text) > CHUNK_BYTES:
                yield close()
                held, about, size = [], [], 0
            held.append(text)
            about.append((lang, key, 0))
            size += len(text) + 1
    if held:
        yield close()


def _parts(text: bytes, lang: str, key, longest: int) -> Iterator[tuple[Chunk, list[tuple]]]:
    """Chunks of one long text, cut between words; each begins with the last ``longest - 1`` words of the one before."""
    codes = np.frombuffer(text, np.uint8)
    begin, skip, before = 0, 0, 0
    at = 0
    while at < len(text):
        end = min(at + CHUNK_BYTES, len(text))
        while end < len(text):  # on to the next separator
            cut = np.flatnonzero(_cuts[codes[end : end + CHUNK_BYTES]])
            if len(cut):
                end += int(cut[0])
                break
            end = min(end + CHUNK_BYTES, len(text))
        chunk = Chunk(text[begin:end], [0], [_seed(lang)], skip)
        yield chunk, [(lang, key, before)]
        skip = min(longest - 1, len(chunk.start))
        before += len(chunk.start) - skip
        begin = begin + int(chunk.start[-skip]) if skip else end
        at = end


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    names = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(names, kind="stable")
    names, counts = names[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
    return names[first], np.add.reduceat(counts, first)


class _Filter:
    """Fingerprints that may be frequent, by the first bits of their values."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def passes(self, names: np.ndarray) -> np.ndarray:
        slot = names >> np.uint64(64 - self.bits)
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _may_extend(chunk: Chunk, prints: list[np.ndarray], n: int, known: _Filter | None) -> np.ndarray:
    """Whether each n-gram is valid and both (n-1)-grams inside it may be frequent."""
    ok = chunk.valid(n)
    if known is not None and len(ok):
        part = known.passes(prints[n - 2])
        ok &= part[: len(ok)] & part[1 : 1 + len(ok)]
    return ok


def _counter(n: int, bits: int, known: Shared | None, buckets: int):
    def run(found):
        take_turn()
        powers = _Powers(BASE)
        flt = None if known is None else _Filter(np.frombuffer(known.value, np.uint64), bits)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for chunk, _ in _chunks(found, n):
            prints = chunk.fingerprints(powers, n)
            names, counts = np.unique(prints[n - 1][_may_extend(chunk, prints, n, flt)], return_counts=True)
            parts.append((names, counts))
            held += len(names)
            if held > HELD:
                parts = [_merged(parts)]
                held = len(parts[0][0])
                if held > HELD // 2:
                    yield from _pack(parts[0], buckets)
                    parts, held = [], 0
        if held:
            yield from _pack(_merged(parts), buckets)

    return run


#: What the shuffle carries: rows of longs sorted by fingerprint, packed by its first bits, or the words of a language.
PACKED = "bucket long, rows binary, lang string, n long"
_PACKED = pa.schema([("bucket", pa.int64()), ("rows", pa.binary()), ("lang", pa.string()), ("n", pa.int64())])


def _bucket_bits(spark: SparkSession) -> int:
    """Bits of a fingerprint that name its bucket: four buckets or more for each shuffle partition."""
    return max(6, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length() + 2)


def _pack(columns: tuple[np.ndarray, ...], bits: int, first: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows sorted by fingerprint, the first column, as one value per bucket; buckets count from ``first``.

    Fingerprints become differences and all bytes of one place lie together, so the many zeros pack away.
    """
    pack = zstandard.ZstdCompressor(level=1).compress
    bounds = np.searchsorted(columns[0] >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    found, blobs = np.flatnonzero(bounds[1:] > bounds[:-1]), []
    for b in found.tolist():
        part = np.array([c[bounds[b] : bounds[b + 1]].view(np.uint64) for c in columns])
        part[0, 1:] = part[0, 1:] - part[0, :-1]
        blobs.append(pack(np.ascontiguousarray(part.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)).tobytes()))
    size = len(found)
    for i in range(0, size, 1000):
        cut = slice(i, i + 1000)
        held = len(blobs[cut])
        yield pa.RecordBatch.from_arrays([pa.array(found[cut].astype(np.int64) + first), pa.array(blobs[cut], pa.binary()), pa.nulls(held, pa.string()), pa.nulls(held, pa.int64())], schema=_PACKED)


def _unpack(raw: bytes, columns: int) -> np.ndarray:
    part = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(columns, 8, -1).transpose(0, 2, 1)
    part = part.copy(order="C").view(np.uint64).reshape(columns, -1)
    part[0] = np.cumsum(part[0], dtype=np.uint64)
    return part


def _by_bucket(found: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Buckets one after the other, each with its (rows, lang, n); rows lie together by bucket."""
    now, held = None, []
    for batch in found:
        for bucket, *row in rows(batch, "bucket", "rows", "lang", "n"):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append(tuple(row))
    if held:
        yield now, held


def _gathered(packed: DataFrame) -> DataFrame:
    """The packed rows of a bucket together: a bucket is an even share of all fingerprints, however often one occurs."""
    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartition(parts, "bucket").sortWithinPartitions("bucket")


def _frequent_of(least: int):
    def run(found):
        for _, held in _by_bucket(found):
            names, counts = _merged([(part[0], part[1].view(np.int64)) for part in (_unpack(raw, 2) for raw, _, _ in held)])
            yield pa.RecordBatch.from_arrays([pa.array(names[counts >= least].view(np.int64))], names=["name"])

    return run


def _frequent(texts: DataFrame, n: int, least: int, bits: int, known: Shared | None) -> Shared:
    """Bitmap of the fingerprints of n-grams that occur ``least`` times or more."""
    packed = texts.mapInArrow(_counter(n, bits, known, _bucket_bits(texts.sparkSession)), PACKED)
    return _bitmap(_gathered(packed).mapInArrow(_frequent_of(least), "name long"), bits)


#: Longs that describe a counted phrase: words, fingerprint, second fingerprint, occurrences, pointer.
COUNTED = "lang string, m long, name long, check long, n long, pointer long"
_COUNTED = pa.schema([("lang", pa.string()), *[(c, pa.int64()) for c in ("m", "name", "check", "n", "pointer")]])


def _runs(names: np.ndarray, checks: np.ndarray, counts: np.ndarray, pointers: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of equal (name, check), with the least pointer, in the order of both."""
    order = np.argsort(names, kind="stable")
    same = names[order]
    if (same[1:] == same[:-1]).any() and (checks[order][1:][same[1:] == same[:-1]] != checks[order][:-1][same[1:] == same[:-1]]).any():
        order = np.lexsort((checks, names))  # several checks of one name may alternate
    names, checks = names[order], checks[order]
    first = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (checks[1:] != checks[:-1]))))
    return names[first], checks[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(pointers[order], first)


def _checks(chunk: Chunk, powers: _Powers, longest: int) -> list[np.ndarray]:
    return [c >> CHECK_SPARE for c in chunk.fingerprints(powers, longest)]


def _pointer_counter(longest: int, bits: int, filters: list[Shared], buckets: int):
    """Counts with a second fingerprint and a pointer for the n-grams that may be frequent, and the words of each language."""

    def run(found):
        take_turn()
        powers, others = _Powers(BASE), _Powers(CHECK_BASE)
        flts = [_Filter(np.frombuffer(f.value, np.uint64), bits) for f in filters]
        totals: dict[str, int] = {}
        parts: list[list[tuple]] = [[] for _ in flts]

        def emit(m):
            held = _runs(*map(np.concatenate, zip(*parts[m - 1])))
            yield from _pack(held, buckets, m << buckets)
            parts[m - 1] = []

        for chunk, about in _chunks(found, longest):
            for doc, n in zip(*np.unique(chunk.doc[chunk.skip :], return_counts=True)):
                lang = about[int(doc)][0]
                totals[lang] = totals.get(lang, 0) + int(n)
            pointers = np.array([key for _, key, _ in about], np.int64)
            prints, checks = chunk.fingerprints(powers, longest), _checks(chunk, others, longest)
            for m in range(1, longest + 1):
                at = np.flatnonzero(chunk.valid(m) & flts[m - 1].passes(prints[m - 1]))
                if len(at):
                    # single words are never cut out, so they need no pointer
                    seen = pointers[chunk.doc[at]] if m > 1 else np.zeros(len(at), np.int64)
                    parts[m - 1].append(_runs(prints[m - 1][at], checks[m - 1][at], np.ones(len(at), np.int64), seen))
                if sum(len(p[0]) for p in parts[m - 1]) > HELD:
                    parts[m - 1] = [_runs(*map(np.concatenate, zip(*parts[m - 1])))]
                    if len(parts[m - 1][0][0]) > HELD // 2:
                        yield from emit(m)
        for m in range(1, longest + 1):
            if parts[m - 1]:
                yield from emit(m)
        if totals:
            size = len(totals)
            keys = [-1 - (_seed(lang) >> (64 - buckets)) for lang in totals]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(size, pa.binary()), pa.array(list(totals)), pa.array(list(totals.values()))], schema=_PACKED)

    return run


def _summed(least: int, buckets: int):
    """Sums of the packed counts of each bucket that reach ``least``, and of the words of each language."""

    def run(found):
        for bucket, held in _by_bucket(found):
            if bucket < 0:
                totals: dict[str, int] = {}
                for _, lang, n in held:
                    totals[lang] = totals.get(lang, 0) + n
                none = pa.nulls(len(totals), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(totals)), none, none, none, pa.array(list(totals.values())), none], schema=_COUNTED)
                continue
            parts = [_unpack(raw, 4) for raw, _, _ in held]
            name, check, n, pointer = _runs(*(np.concatenate([p[i] for p in parts]).view(np.uint64 if i < 2 else np.int64) for i in range(4)))
            often = n >= least
            size = int(often.sum())
            longs = [pa.array(c[often].view(np.int64)) for c in (name, check, n, pointer)]
            yield pa.RecordBatch.from_arrays([pa.nulls(size, pa.string()), pa.array(np.full(size, bucket >> buckets)), *longs], schema=_COUNTED)

    return run


def _bitmap(slots: DataFrame, bits: int) -> Shared:
    """Bitmap of the first ``bits`` bits of the longs in column ``name``; at most 2**bits / 64 words reach the driver."""
    slot = slots.select(F.shiftrightunsigned("name", 64 - bits).alias("slot"))
    words = slot.selectExpr("slot >>> 6 as word", "shiftleft(1L, cast(slot & 63 as int)) as bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    bitmap = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return Shared(slots.sparkSession, bitmap.tobytes())


def _pointed_at(bits: int, known: Shared):
    """The texts that some pointer may point at, packed."""

    def run(found):
        flt, pack = _Filter(np.frombuffer(known.value, np.uint64), bits), zstandard.ZstdCompressor(level=1).compress
        for batch in found:
            keys = batch.column(batch.schema.names.index("_id")).to_numpy().view(np.uint64)
            kept = batch.filter(pa.array(flt.passes(keys << SPARE)))
            texts = kept.schema.names.index("_text")
            yield kept.set_column(texts, kept.schema.field(texts), pa.array([pack(t.as_py()) for t in kept.column(texts)], pa.binary()))

    return run


PHRASE = "lang string, m long, name long, check long, a long, phrase string, parts array<long>, inner array<long>"


def _cutter(longest: int):
    """Phrases cut from the texts their pointers point at, with the fingerprints of the parts of every cut."""
    longs = pa.list_(pa.int64())
    out = pa.schema([("lang", pa.string()), ("m", pa.int64()), ("name", pa.int64()), ("check", pa.int64()), ("a", pa.int64()), ("phrase", pa.string()), ("parts", longs), ("inner", longs)])

    def run(found):
        take_turn()
        powers, others = _Powers(BASE), _Powers(CHECK_BASE)
        unpack = zstandard.ZstdDecompressor().decompress

        def records():
            for batch in found:
                lists = batch.column(batch.schema.names.index("wanted"))
                wanted = [lists.flatten().field(f).to_numpy().view(np.uint64) for f in ("m", "name", "check", "a")]
                order = np.argsort(wanted[1], kind="stable")
                ms, names, sums, counts = (w[order] for w in wanted)
                done = np.zeros(len(names), bool)
                texts = pa.array([unpack(t.as_py()) for t in batch.column(batch.schema.names.index("_text"))], pa.binary())
                plain = pa.RecordBatch.from_arrays([texts, *(batch.column(batch.schema.names.index(c)) for c in ("_lang", "_id"))], names=["_text", "_lang", "_id"])
                for chunk, about in _chunks([plain], longest):
                    prints = chunk.fingerprints(powers, longest), _checks(chunk, others, longest)
                    pair = lambda n, i: [int(p[n - 1][i].view(np.int64)) for p in prints]
                    for m in range(2, longest + 1):
                        here = prints[0][m - 1]
                        lo, hi = np.searchsorted(names, here, "left"), np.searchsorted(names, here, "right")
                        at = np.flatnonzero(chunk.valid(m) & (lo < hi))
                        at = at[np.lexsort((prints[1][m - 1][at], here[at]))]
                        name, check = here[at], prints[1][m - 1][at]
                        fresh = np.ones(len(at), bool)
                        fresh[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
                        for i in at[fresh].tolist():
                            for w in range(int(lo[i]), int(hi[i])):  # several only where fingerprints collide
                                if done[w] or ms[w] != m or sums[w] != prints[1][m - 1][i]:
                                    continue
                                done[w] = True
                                parts = [x for k in range(1, m) for x in (*pair(k, i), *pair(m - k, i + k))]
                                inner = [x for n in range(2, m) for j in range(m - n + 1) for x in pair(n, i + j)]
                                lang = about[int(chunk.doc[i])][0]
                                yield lang, m, *pair(m, i), int(counts[w]), chunk.phrase(i, m).decode("utf-8", "replace"), parts, inner

        yield from batches(records(), out, 20_000)

    return run


def count_phrases(
    docs: DataFrame, longest: int = 3, least: int = 10, text_col: str = "text", lang_col: str = "lang", filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of 1 to ``longest`` words that occur ``least`` times or more in a language, and the texts of those of 2 and more.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``;
    a phrase is words of one piece, joined by one space, counted with overlaps in each language. The first table has
    ``(lang, m, name, check, n, pointer)``: number of words, two fingerprints that name phrase and language, count, and
    the least digest of a text that has it; one row for each language (the only ones with ``lang``) has the number of
    all its words. The second has ``(lang, m, name, check, a, phrase, parts, inner)``: the phrase, the names and checks of both
    parts of each cut, and those of all shorter phrases of two and more words inside. A null text has no words, a null
    language is ``und``; repeated rows count each. Texts of any length are cut between words, phrases across the cut
    included. Empty tables give no rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col), F.lit("und"))
    texts = docs.select(text_bytes(text_col).alias("_text"), lang.alias("_lang")).withColumn("_id", F.shiftrightunsigned(F.xxhash64("_lang", "_text"), int(SPARE)))
    filters: list[Shared] = []
    for n in range(1, longest + 1):
        filters.append(_frequent(texts, n, least, filter_bits, filters[-1] if filters else None))
    buckets = _bucket_bits(docs.sparkSession)
    packed = texts.mapInArrow(_pointer_counter(longest, filter_bits, filters, buckets), PACKED)
    counted = _gathered(packed).mapInArrow(_summed(least, buckets), COUNTED).checkpoint()

    long = counted.where("m > 1")
    needed = _bitmap(long.select(F.shiftleft("pointer", int(SPARE)).alias("name")), filter_bits)
    pages = texts.mapInArrow(_pointed_at(filter_bits, needed), texts.schema)
    # copies of a text leave a task once; the few other texts of a digest stay
    pages = pages.groupBy("_id", F.md5("_text")).agg(F.first("_lang").alias("_lang"), F.first("_text").alias("_text")).select("_id", "_lang", "_text")
    wanted = long.groupBy(F.col("pointer").alias("_id")).agg(F.collect_list(F.struct("m", "name", "check", F.col("n").alias("a"))).alias("wanted"))
    return counted, pages.join(wanted, "_id").mapInArrow(_cutter(longest), PHRASE).checkpoint()


def score_phrases(counted: DataFrame, phrases: DataFrame, covered: int = 50, longest: int = 3) -> DataFrame:
    """Rows ``(lang, phrase, a, l, r, n, score)`` for the phrases of two and more words of ``count_phrases``.

    Every cut of a phrase into two parts scores ``floor(1000000 * a * a / (l * r))`` from the counts of the phrase and
    its parts; the lowest counts, the one after the fewest words if several are lowest. Phrases inside a longer one
    that is at least ``covered`` percent as frequent are left out.
    """
    sides = phrases.select(
        "name", "check", F.expr("inline(transform(sequence(0, size(parts) div 2 - 1), i -> struct(i as side, parts[2 * i] as part, parts[2 * i + 1] as part_check)))")
    )
    known = counted.where("lang is null").select(F.col("name").alias("part"), F.col("check").alias("part_check"), F.col("n").alias("f"))
    # two counts for each cut, in the order of the cuts; everything from here on stays with the phrase
    most = 2 * (longest - 1)
    counts = sides.join(known, ["part", "part_check"]).groupBy("name", "check").agg(*[F.max(F.expr(f"if(side = {i}, f, null)")).alias(f"c{i}") for i in range(most)])
    # texts of one pointer may give a phrase more than once
    whole = phrases.select("name", "check", "lang", "phrase", "a").dropDuplicates(["name", "check"])
    wide = "cast({} as decimal(19, 0))"
    exact = f"(1000000bd * {wide.format('a')} * {wide.format('a')}) div ({{}} * {{}})"
    cuts = [
        f"if(c{2 * k - 2} is null, null, struct({exact.format(wide.format(f'c{2 * k - 2}'), wide.format(f'c{2 * k - 1}'))} as score, {k} as k, c{2 * k - 2} as l, c{2 * k - 1} as r))"
        for k in range(1, longest)
    ]
    best = counts.join(whole, ["name", "check"]).select("name", "check", "lang", "phrase", "a", F.expr(f"array_min(array({', '.join(cuts)}))").alias("cut"))
    # the most frequent holder of every shorter phrase
    inner = phrases.where("size(inner) > 0").select(
        F.expr("inline(transform(sequence(0, size(inner) div 2 - 1), i -> struct(inner[2 * i] as name, inner[2 * i + 1] as check, a as f)))")
    )
    holders = inner.groupBy("name", "check").agg(F.max("f").alias("_held"))
    kept = best.join(holders, ["name", "check"], "left").where(F.expr(f"_held is null or 100 * _held < {int(covered)} * a"))
    totals = counted.where("lang is not null").select("lang", "n")
    return kept.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top_phrases(scored: DataFrame, first: int = 2000) -> DataFrame:
    """The ``first`` phrases of each language by score, count (both descending) and phrase, with ``rank`` from 1.

    A histogram of the scores (at most 10,001 classes a language) gives the class in which the last of them lies; only
    phrases from there on are ordered, by running totals over range partitions, so no task holds a language as a whole.
    """
    level = F.expr("score div 100")
    classes = scored.groupBy("lang", level.alias("level")).agg(F.count("*").alias("_n"))
    above = F.sum("_n").over(W.partitionBy("lang").orderBy(F.col("level").desc()).rowsBetween(W.unboundedPreceding, -1))
    least = classes.withColumn("_above", above).where(F.coalesce("_above", F.lit(0)) < first).groupBy("lang").agg(F.min("level").alias("_least"))
    columns = scored.columns
    scored = scored.join(least, "lang").where(level >= F.col("_least")).select(columns)
    numbered = with_running_totals(
        scored.select("*", (-F.col("score")).alias("_score"), (-F.col("a")).alias("_a"), F.lit(1).alias("_one")), ["lang", "_score", "_a", "phrase"], "_one"
    )
    # one row per language
    starts = numbered.groupBy("lang").agg(F.min("_index").alias("_start"))
    ranked = numbered.join(starts, "lang").withColumn("rank", (F.col("_index") - F.col("_start") + 1).cast("long"))
    return ranked.where(F.col("rank") <= first).select("rank", *scored.columns)


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, first: int = 2000, **names) -> DataFrame:
    """Rows ``(lang, rank, phrase, a, l, r, n, score)``: the strongest phrases of each language.

    Cases are those of ``count_phrases``; ties are settled by the order of ``top_phrases``.
    """
    counted, phrases = count_phrases(docs, longest, least, **names)
    return top_phrases(score_phrases(counted, phrases, covered, longest).checkpoint(), first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
