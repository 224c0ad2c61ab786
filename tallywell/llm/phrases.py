"""Phrase collocation mining: Misra-Gries summaries find the frequent word runs, a second pass counts them exactly.

Words are counted first. A run of words is at most as frequent as any run
inside it, so pairs are summarised only where both words are frequent, and
longer runs only where all their pairs survived. What survived is handed to
the tasks as a bit table of fixed size over hashes: it lets too much through
where it is crowded, and never too little.

The hashes of the runs are dealt to hash partitions. A partition's summary
holds more counters than its mass divided by the threshold; when it is full,
the count that fits no more is taken from all. What is taken in total stays
below the threshold, so every run that reaches it survives, whatever else
shares its partition. Slices of a task are summed before anything moves, and
the summaries of slices merge in any order. The second pass counts the
survivors by their words, exactly.

A phrase's score is 2,000,000 times its count over the counts of the two parts
of its worst cut, in whole numbers of up to 38 digits. Phrases that are nearly
always part of a longer one go.

Cases: a null text is empty and a null language is ``und``; repeated rows count
as often as they occur; a phrase never crosses a separator; ties go to the
smaller cut and to the smaller phrase by its bytes; no phrase, no row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.rows import quoted
from tallywell.session import staged

LEAST, LONGEST, TOP, INSIDE = 30, 4, 2000, 80
#: Bits of a table of survivors; bytes of text for each hash partition; characters of text in a slice; keys merged at once.
TABLE_BITS, PART_BYTES, SLICE_CHARS, MERGE = 26, 1 << 27, 4_000_000, 1 << 18
PIECE = re.compile(rb"[.,;:!?\x0a-\x0d]")
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pieces_of(text: str) -> list[list[bytes]]:
    """The words of each piece; A-Z in lower case."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    return [words for words in map(bytes.split, PIECE.split(raw)) if words]


class Slice:
    """Words of some texts of one language as numbers, the pieces apart by -1, and hashes of the words."""

    def __init__(self, lang: str, texts: list[str]):
        number: dict[bytes, int] = {}
        ids: list[int] = []
        for text in texts:
            for words in pieces_of(text):
                ids.extend([number.setdefault(w, len(number)) for w in words])
                ids.append(-1)
        self.lang, self.words = lang, list(number)
        self.ids = np.array(ids, np.int64)
        seed = xxhash.xxh3_64_intdigest(lang)
        self.hash = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in self.words] + [0], np.uint64)[self.ids]

    def runs(self, size: int, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First places and hashes of the runs of ``size`` words at the places that fit."""
        at = np.flatnonzero(fits[:max(0, len(self.ids) - size + 1)])
        out = np.full(len(at), size, np.uint64)
        for k in range(size):
            out = _mix(out * MIX + self.hash[at + k])
        return at, out

    def inside(self, size: int) -> np.ndarray:
        """At which places ``size`` words of one piece begin."""
        fits = np.zeros(len(self.ids), bool)
        n = max(0, len(self.ids) - size + 1)
        fits[:n] = True
        for k in range(size):
            fits[:n] &= self.ids[k:k + n] >= 0
        return fits

    def texts(self, at: np.ndarray, size: int) -> tuple[list[str], np.ndarray]:
        """Distinct runs at the places, by their words and not by hashes, and their counts."""
        key = self.ids[at]
        for k in range(1, size):
            key = np.unique(key, return_inverse=True)[1] * np.int64(len(self.words)) + self.ids[at + k]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        words = self.words
        spelled = [b" ".join([words[i] for i in self.ids[p:p + size]]).decode("utf-8", "surrogatepass") for p in at[first].tolist()]
        return spelled, count


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    """Texts gathered by language up to a bounded number of characters."""
    held: dict[str, list[str]] = {}
    chars = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, []).append(text)
            chars += len(text)
            if chars >= SLICE_CHARS:
                yield from (Slice(own, texts) for own, texts in held.items())
                held, chars = {}, 0
    yield from (Slice(own, texts) for own, texts in held.items())


def _map_slices(docs: DataFrame, work: Callable[[Slice], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _slices(batches):
            yield from work(own)

    return docs.mapInArrow(run, schema)


# -- bit tables ------------------------------------------------------------
def bit_table(keys: DataFrame) -> np.ndarray:
    """The table of the column ``key``; as many words as it has bits over 64 at most come to the driver."""
    place = F.shiftrightunsigned("key", 32 - TABLE_BITS)
    rows = keys.select(F.shiftrightunsigned(place, 6).alias("word"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(key, {32 - TABLE_BITS}) & 63 AS int))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - TABLE_BITS)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


# -- summaries -------------------------------------------------------------
class Summary:
    """Misra-Gries summary: at most ``capacity`` counters, each too small by ``taken`` at most."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take in counters, of another summary or of a slice; many are merged at once."""
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > max(self.capacity, MERGE):
            self.merge()

    def merge(self) -> None:
        keys, place = np.unique(np.concatenate([self.keys, *[k for k, _ in self.waiting]]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, place, np.concatenate([self.counts, *[n for _, n in self.waiting]]))
        self.waiting, self.held = [], 0
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            cut = int(np.partition(sums, at)[at])
            self.taken += cut
            sums -= cut
            keys, sums = keys[sums > 0], sums[sums > 0]
        self.keys, self.counts = keys, sums


COUNTS = "part int, mass long, once binary, more binary, times binary"


def packed_counts(found: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """Per hash partition the keys of a slice that occur once, the others, and how often those do.

    A key is the upper half of a hash and the partition is drawn from the lower
    one, so the counts of a key are those of a run or more.
    """
    hashes, counts = np.unique(np.concatenate(found), return_counts=True)
    part = ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, keys, counts = part[order], (hashes[order] >> np.uint64(32)).astype(np.uint32), counts[order].astype(np.uint32)
    held, first = np.unique(part, return_index=True)
    rows = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(part)]):
        own, n = keys[a:b], counts[a:b]
        rows.append((int(n.sum()), own[n == 1].tobytes(), own[n > 1].tobytes(), n[n > 1].tobytes()))
    mass, once, more, times = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(held), pa.array(mass, pa.int64()), *[pa.array(c, pa.binary()) for c in (once, more, times)]],
                                      names=["part", "mass", "once", "more", "times"])


def survivors(partial: DataFrame, least: int, parts: int) -> DataFrame:
    """``key``: every key whose counts in ``partial`` (``COUNTS``) reach ``least``, and few others."""
    kept = staged(partial, "run-counts")
    # One number per hash partition.
    mass = {r.part: r.mass for r in kept.groupBy("part").agg(F.sum("mass").alias("mass")).collect()}
    shared = partial.sparkSession.sparkContext.broadcast(mass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries: dict[int, Summary] = {}
        for batch in batches:
            for i, p in enumerate(batch.column(0).to_pylist()):
                if p not in summaries:
                    summaries[p] = Summary(shared.value[p] // least + 1)
                once, more, times = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint32).astype(np.int64) for c in (1, 2, 3))
                summaries[p].add(once, np.ones(len(once), np.int64))
                summaries[p].add(more, times)
        for s in summaries.values():
            s.merge()
            yield pa.RecordBatch.from_arrays([pa.array(s.keys[s.counts + s.taken >= least])], names=["key"])

    dealt = kept.select("part", "once", "more", "times").repartition(parts, "part")
    return staged(dealt.mapInArrow(run, "key long"), "survivors")


# -- mining ----------------------------------------------------------------
def frequent_runs(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, n`` of every run of up to ``longest`` words that occurs ``least`` times, and ``lang, words``."""
    spread = spark_texts(docs, lang_col, text_col)
    sc = docs.sparkSession.sparkContext
    size = spread.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + size // PART_BYTES)

    def count_words(own: Slice) -> Iterator[pa.RecordBatch]:
        count = np.bincount(own.ids[own.ids >= 0], minlength=len(own.words))
        yield _spelled(own.lang, [w.decode("utf-8", "surrogatepass") for w in own.words], 1, count)

    schema = "lang string, phrase string, size int, n long"
    words = staged(_map_slices(spread, count_words, schema).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    often = words.where(F.col("n") >= least)
    one = sc.broadcast(bit_table(_word_hashes(often)))

    def pairs(own: Slice) -> Iterator[pa.RecordBatch]:
        _, h = own.runs(2, _both(own, one.value))
        if len(h):
            yield packed_counts([h], parts)

    two = sc.broadcast(bit_table(survivors(_map_slices(spread, pairs, COUNTS), least, parts)))

    def longer(own: Slice) -> Iterator[pa.RecordBatch]:
        pair = _surviving(own, 2, _both(own, one.value), two.value)
        found = [own.runs(k, _all(pair, k - 1) & own.inside(k))[1] for k in range(3, longest + 1)]
        if any(map(len, found)):
            yield packed_counts(found, parts)

    more = sc.broadcast(bit_table(survivors(_map_slices(spread, longer, COUNTS), least, parts)))

    def exact(own: Slice) -> Iterator[pa.RecordBatch]:
        pair = _surviving(own, 2, _both(own, one.value), two.value)
        for k in range(2, longest + 1):
            fits = pair if k == 2 else _surviving(own, k, _all(pair, k - 1) & own.inside(k), more.value)
            at = np.flatnonzero(fits)
            if len(at):
                yield _spelled(own.lang, *_sized(own, at, k))

    counted = (_map_slices(spread, exact, schema).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= least))
    return staged(often.unionByName(counted), "frequent-runs"), totals


def _sized(own: Slice, at: np.ndarray, size: int):
    spelled, count = own.texts(at, size)
    return spelled, size, count


def _spelled(lang: str, phrases: list[str], size: int, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()),
                                       pa.array(np.full(len(phrases), size, np.int32)), pa.array(count.astype(np.int64))],
                                      names=["lang", "phrase", "size", "n"])


def _both(own: Slice, table: np.ndarray) -> np.ndarray:
    """Places of two words that are both frequent."""
    single = _surviving(own, 1, own.inside(1), table)
    return _all(single, 2) & own.inside(2)


def _surviving(own: Slice, size: int, fits: np.ndarray, table: np.ndarray) -> np.ndarray:
    at, h = own.runs(size, fits)
    out = np.zeros(len(own.ids), bool)
    out[at[in_table(table, h)]] = True
    return out


def _all(fits: np.ndarray, times: int) -> np.ndarray:
    """Places from which ``times`` places in a row fit."""
    out = np.zeros(len(fits), bool)
    n = max(0, len(fits) - times + 1)
    out[:n] = True
    for k in range(times):
        out[:n] &= fits[k:k + n]
    return out


def _word_hashes(words: DataFrame) -> DataFrame:
    """``key`` of the words' runs of one word, as the slices hash them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds: dict[str, int] = {}
            plain = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), seeds.setdefault(
                lang, xxhash.xxh3_64_intdigest(lang))) for lang, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((_mix(MIX + plain) >> np.uint64(32)).astype(np.int64))], names=["key"])

    return words.select("lang", "phrase").mapInArrow(run, "key long")


def spark_texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(quoted(lang_col)).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"))


def scored(runs: DataFrame, inside: int = INSIDE) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases that are not nearly always part of a longer one."""
    words = F.split("phrase", " ")
    candidates = runs.where("size >= 2").withColumnRenamed("n", "a")
    join = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = (candidates.withColumn("w", words).select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("first"), join(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")))
    part = lambda name, as_: runs.select("lang", F.col("phrase").alias(name), F.col("n").alias(as_))
    told = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    worth = F.expr("(cast(2000000 AS decimal(7,0)) * cast(a AS decimal(19,0))) div (cast(l AS decimal(19,0)) + cast(r AS decimal(19,0)))")
    worst = (told.select("lang", "phrase", "a", F.struct(worth.alias("score"), "k", "l", "r").alias("cut"))
             .groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut")))
    # Every run inside a longer candidate meets the most frequent of them.
    inner = (candidates.where("size >= 3").withColumn("w", words)
             .select("lang", "a", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("n"))
             .select("lang", "a", "w", "n", F.explode(F.expr("sequence(1, size - n + 1)")).alias("at"))
             .select("lang", join(F.col("at"), F.col("n")).alias("phrase"), "a"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    over = F.expr(f"cast(100 AS decimal(3,0)) * cast(longer AS decimal(19,0)) >= cast({inside} AS decimal(3,0)) * cast(a AS decimal(19,0))")
    return (worst.join(longest, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~over)
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def mine_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, inside: int = INSIDE,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases."""
    runs, totals = frequent_runs(docs, least, longest, lang_col, text_col)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored(runs, inside).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (ranked.join(totals.withColumnRenamed("words", "n"), "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
