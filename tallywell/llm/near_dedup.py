"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text's features are its runs of five words. A shingle weighs its count times
an idf from 1 (in every document) to 2 (in at most a hundredth of them).
Documents are counted by hash bucket, over all documents, in a table of fixed
width; where texts are so long that buckets run full, the shingles of buckets
that many documents have are counted exactly.

Consistent weighted sampling draws from each text samples that two texts share
with a probability equal to their weighted Jaccard similarity. Four samples
form a band; texts that share a band are candidates. Candidates are compared
sample by sample, and those that may reach the threshold are verified by the
weighted Jaccard similarity of their whole shingle sets.

Texts with the same words are one node from the start, so thousands of copies
cost one signature each and no pair. Within a band's bucket every node meets
the bucket's smallest node and, in a bucket that still holds several classes,
the smallest and largest node of each part that shares a second band; pairs
already in one class are not compared. So the number of these pairs is a small
multiple of the nodes, whatever the size of a bucket, and no bucket is held in
memory.

Nodes of buckets that then still hold several classes meet by their rarest
shingles. Two texts of weights A and B reach similarity t only if they share a
weight of t / (1 + t) (A + B), so they share a shingle among the first of each,
rarest first, before less than that is left. This loses no pair, and a core
that a whole family shares is not among those shingles while the family is
below t. Each key is met first through the text that has least beside it, which
joins a family before its classes meet pair by pair. Pairs of one class, and
pairs that cannot reach t by what is left from the key on, are never made. Nodes of a class share a chain of
verified pairs; the class id is its smallest document id.

Cases: a text without a word is alone in its class; a text of fewer than five
words has one shingle; rows with a null id can be in classes and never name
one, unless all ids of the class are null; repeated rows are one class.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.components import connected_components
from tallywell.llm.rows import SLICE, quoted
from tallywell.session import staged

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 14, 4
SAMPLES = BANDS * ROWS
#: Buckets of document counts, share of documents up to which a shingle counts as rare.
BUCKET_BITS, RARE = 18, 0.01
#: Share of equal samples below which a pair is not verified: six deviations under the threshold.
LEAST_EQUAL = 0.5
POOL_BITS = 14
#: Ratio of neighbouring weight steps in the join by rarest shingles, rows of a key that meet in one place, rounding.
STEP, CROWD, SLACK = 1.25, 256, 1e-5
#: Times that keys are met through one text of theirs first; most bits of a table of row hashes.
CENTRES, MOST_BITS = 3, 26
MEMO_WORDS = 200_000

WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


# -- shingles --------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Distinct shingle hashes of texts, with counts; remembers the hashes of words."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.memo: dict[str, int] = {}

    def hashes(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        span = min(self.size, len(ids))
        out = np.full(len(ids) - span + 1, span, np.uint64)
        for k in range(span):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[k:len(ids) - span + 1 + k]
        return _mix(out)

    def rows(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts' distinct hashes in order, their counts, and how many each text has."""
        parts = [np.unique(self.hashes(words), return_counts=True) for words in split]
        sizes = np.array([len(h) for h, _ in parts], np.int64)
        return (np.concatenate([h for h, _ in parts] or [np.empty(0, np.uint64)]),
                np.concatenate([n for _, n in parts] or [np.empty(0, np.int64)]), sizes)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _shingled(docs: DataFrame, text_col: str, size: int, work, schema: str) -> DataFrame:
    """``work(hashes, sizes)`` of slices of texts; it yields while it goes and once more at the end, with None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, own = Shingler(size), work()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                hashes, _, sizes = shingler.rows([words_of(t or "") for t in batch.column(0).slice(at, SLICE).to_pylist()])
                yield from own(hashes, sizes)
        yield from own(None, None)

    return docs.select(F.col(quoted(text_col)).cast("string")).mapInArrow(run, schema)


def document_counts(docs: DataFrame, text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``bucket, n``: how many documents have a shingle of a hash bucket; bucket -1 counts the documents."""
    def work():
        counts, texts = np.zeros(1 << BUCKET_BITS, np.int64), [0]

        def count(hashes, sizes):
            if hashes is not None:
                texts[0] += int((sizes > 0).sum())
                # The hashes of a text are in order, so its buckets are too and each counts once.
                own = np.repeat(np.arange(len(sizes)), sizes) << BUCKET_BITS | _bucket(hashes)
                new = np.append(True, own[1:] != own[:-1])[:len(own)]
                np.add(counts, np.bincount(own[new] & ((1 << BUCKET_BITS) - 1), minlength=1 << BUCKET_BITS), out=counts)
                return
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1).astype(np.int32)),
                                              pa.array(np.append(counts[held], texts[0]))], names=["bucket", "n"])

        return count

    return _shingled(docs, text_col, size, work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def common_shingles(docs: DataFrame, buckets: np.ndarray, text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``h, n``: exact document counts of the shingles in the buckets marked."""
    shared = docs.sparkSession.sparkContext.broadcast(buckets)

    def work():
        held: list[np.ndarray] = []

        def count(hashes, sizes):
            if hashes is not None:
                held.append(hashes[shared.value[_bucket(hashes)]])
            if held and (hashes is None or sum(map(len, held)) > 1 << 20):
                keys, n = np.unique(np.concatenate(held), return_counts=True)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["h", "n"])

        return count

    return _shingled(docs, text_col, size, work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


class Idf:
    """Idf of shingles: by hash bucket, or by shingle where buckets hold too many."""

    def __init__(self, by_bucket: np.ndarray, common: np.ndarray | None = None, hashes: np.ndarray | None = None, values: np.ndarray | None = None):
        self.by_bucket, self.common = by_bucket.astype(np.float32), common
        if common is not None:
            order = np.argsort(hashes)
            self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if self.common is None:
            return self.by_bucket[_bucket(hashes)]
        out = np.full(len(hashes), 2, np.float32)
        if len(self.hashes):
            some = np.flatnonzero(self.common[_bucket(hashes)])
            at = np.searchsorted(self.hashes, hashes[some])
            at[at == len(self.hashes)] = 0
            found = self.hashes[at] == hashes[some]
            out[some[found]] = self.values[at[found]]
        return out


def idf_table(docs: DataFrame, text_col: str = "text", size: int = SHINGLE, rare: float = RARE) -> Idf:
    """1 + ln(1 / share) / ln(1 / rare), the share of documents taken as ``rare`` at least.

    A bucket's share is that of its most common shingle and, besides, about the
    mean share of all buckets. While that mean is below a quarter of ``rare`` the
    buckets tell common shingles; above it, as with very long texts, the shingles
    of buckets with more than that share are counted one by one. Those are at most
    1 / ``rare`` times as many as a text has shingles on average.
    """
    kept = staged(document_counts(docs, text_col, size), "shingle-counts")
    total = kept.where("bucket = -1").agg(F.sum("n")).first()[0] or 1
    held = kept.where("bucket >= 0")
    mean = (held.agg(F.sum("n")).first()[0] or 0) / total / (1 << BUCKET_BITS)
    # As many rows as the table has buckets at most.
    crowded = held.where(F.col("n") > rare * total).toArrow()
    idf = lambda n: 1 + np.log(1 / np.minimum(1.0, n.to_numpy() / total)) / np.log(1 / rare)
    table = np.full(1 << BUCKET_BITS, 2.0)
    at = crowded.column("bucket").to_numpy()
    if mean <= rare / 4:
        table[at] = idf(crowded.column("n"))
        return Idf(table)
    common = np.zeros(1 << BUCKET_BITS, bool)
    common[at] = True
    found = common_shingles(docs, common, text_col, size).where(F.col("n") > rare * total).toArrow()
    return Idf(table, common, found.column("h").to_numpy().view(np.uint64), idf(found.column("n")))


# -- samples ---------------------------------------------------------------
class Sampler:
    """Improved consistent weighted sampling with pooled random variables."""

    def __init__(self, samples: int = SAMPLES, seed: int = 5):
        draw = np.random.default_rng(seed)
        pool = 1 << POOL_BITS
        self.r = draw.gamma(2.0, 1.0, pool).astype(np.float32)
        self.by_r = (1 / self.r).astype(np.float32)
        self.log_c = np.log(draw.gamma(2.0, 1.0, pool)).astype(np.float32)
        self.beta = draw.random(pool).astype(np.float32)
        self.odd = draw.integers(1, 2**63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def draw(self, hashes: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each text with a shingle a row of samples, each naming a shingle and a weight level."""
        starts = np.cumsum(sizes) - sizes
        log_weight = np.log(weights).astype(np.float32)
        place = np.arange(len(hashes), dtype=np.int64)
        mask, shift = np.uint64((1 << POOL_BITS) - 1), [np.uint64(s) for s in (64 - POOL_BITS, 64 - 2 * POOL_BITS, 64 - 3 * POOL_BITS)]
        out = np.empty((len(sizes), len(self.odd)), np.uint32)
        for k, odd in enumerate(self.odd):
            x = hashes * odd
            first = (x >> shift[0]).astype(np.int64)
            second, third = ((x >> shift[1]) & mask).astype(np.int64), ((x >> shift[2]) & mask).astype(np.int64)
            beta = self.beta[third]
            level = np.floor(log_weight * self.by_r[first] + beta)
            # ln a = ln c - ln y - r with ln y = r (level - beta)
            value = self.log_c[second] - self.r[first] * (level - beta + np.float32(1))
            bits = value.view(np.int32)
            key = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))
            best = np.minimum.reduceat((key.astype(np.int64) << 32) | place, starts) & 0xFFFFFFFF
            named = hashes[best] + level[best].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            out[:, k] = (_mix(named) >> np.uint64(32)).astype(np.uint32)
        return out


def bands_of(samples: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Per text a hash of each band's number and samples."""
    bands = samples.shape[1] // rows
    parts = samples.reshape(len(samples), bands, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(samples), bands)).copy()
    for k in range(rows):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return out.view(np.int64)


def signatures(docs: DataFrame, idf, id_col: str, text_col: str, size: int) -> DataFrame:
    """``doc, row_a, row_b, node, samples, bands`` of each row; node names the text's words, null without one."""
    doc, text = F.col(quoted(id_col)), F.col(quoted(text_col)).cast("string")
    source = docs.select(doc.alias("doc"), *row_key(doc, text), text.alias("text"))
    kind = source.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sampler, table = Shingler(size), Sampler(), idf.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                split = [words_of(t or "") for t in part.column(3).to_pylist()]
                nodes = [xxhash.xxh3_128_digest(" ".join(w)) if w else None for w in split]
                hashes, counts, sizes = shingler.rows(split)
                has = np.flatnonzero(sizes)
                samples: list = [None] * len(split)
                bands: list = [None] * len(split)
                if len(has):
                    drawn = sampler.draw(hashes, counts * table.of(hashes), sizes[has])
                    for i, s, b in zip(has.tolist(), drawn.view(np.int32), bands_of(drawn)):
                        samples[i], bands[i] = s, b
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(3)], pa.array(nodes, pa.binary()),
                     pa.array(samples, pa.list_(pa.int32())), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc", "row_a", "row_b", "node", "samples", "bands"])

    return source.mapInArrow(run, f"doc {kind}, row_a long, row_b long, node binary, samples array<int>, bands array<long>")


def row_key(doc, text):
    """Two hashes that name a row by its id and text, never null."""
    return F.xxhash64(doc, text).alias("row_a"), F.xxhash64(F.lit(1), doc, text).alias("row_b")


# -- pairs -----------------------------------------------------------------
def _stars(buckets: DataFrame) -> DataFrame:
    """``u, v``: every node of a bucket with the bucket's smallest node."""
    centre = buckets.groupBy("bucket").agg(F.min("node").alias("u"), F.max("node").alias("other")).where("u != other")
    return (buckets.join(centre.select("bucket", "u"), "bucket").where("node != u")
            .select("u", F.col("node").alias("v")))


def _alike(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs whose share of equal samples is at least ``least``."""
    left = nodes.select(F.col("node").alias("u"), F.col("samples").alias("a"))
    right = nodes.select(F.col("node").alias("v"), F.col("samples").alias("b"))
    same = F.size(F.filter(F.zip_with("a", "b", lambda x, y: x == y), lambda e: e))
    return pairs.join(left, "u").join(right, "v").where(same >= int(least * SAMPLES)).select("u", "v")


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Similarity of two sorted feature rows with weights."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = b[at] == a
    low = np.minimum(wa[both], wb[at[both]]).sum(dtype=np.float64)
    return float(low / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - low))


def key_table(keys: DataFrame, name: str) -> np.ndarray:
    """Bits of a column of hashes, in a table of bounded size: it holds all of them, and few others while it is not crowded."""
    bits = min(MOST_BITS, max(16, (16 * keys.count()).bit_length()))
    place = F.shiftrightunsigned(name, 64 - bits)
    rows = keys.select(F.shiftrightunsigned(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned({name}, {64 - bits}) & 63 AS int))").alias("bit"))
    # As many rows as the table has bits over 64 at most.
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() + 5
    place = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def _features(close: DataFrame, signed: DataFrame, docs: DataFrame, idf, id_col: str, text_col: str, size: int) -> DataFrame:
    """``node, h, w``: sorted shingle hashes of the nodes and their weights, packed; a few other nodes may be there too.

    Texts are read where they lie and none is shuffled: a table of bits tells
    the rows of these nodes from nearly all others.
    """
    doc, text = F.col(quoted(id_col)), F.col(quoted(text_col)).cast("string")
    first = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("row_a").alias("row_a")).join(close, "node")
    wanted = docs.sparkSession.sparkContext.broadcast(key_table(staged(first.select("row_a"), "wanted"), "row_a"))

    def shingle(batches):
        shingler, table, seen = Shingler(size), idf.value, set()
        for batch in batches:
            fits = in_table(wanted.value, batch.column(0).to_numpy())
            rows = batch.column(1).filter(pa.array(fits))
            for at in range(0, len(rows), SLICE):
                split = [words_of(t or "") for t in rows.slice(at, SLICE).to_pylist()]
                named = {xxhash.xxh3_128_digest(" ".join(w)): w for w in split if w}
                named = {n: w for n, w in named.items() if n not in seen}
                seen.update(named)
                hashes, counts, sizes = shingler.rows(list(named.values()))
                weights = (counts * table.of(hashes)).astype(np.float32)
                ends = np.cumsum(sizes)
                cut = list(zip((ends - sizes).tolist(), ends.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(named), pa.binary()), pa.array([hashes[a:b].tobytes() for a, b in cut], pa.binary()),
                     pa.array([weights[a:b].tobytes() for a, b in cut], pa.binary())], names=["node", "h", "w"])

    keyed = docs.select(row_key(doc, text)[0], text.alias("text"))
    # A task tells a node once; rows of the same id and text in several tasks tell it again.
    return staged(keyed.mapInArrow(shingle, "node binary, h binary, w binary").dropDuplicates(["node"]), "shingles")


def _verified(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes whose weighted Jaccard similarity reaches the threshold."""
    met = (pairs.join(held.select(F.col("node").alias("u"), F.col("h").alias("hu"), F.col("w").alias("wu")), "u")
           .join(held.select(F.col("node").alias("v"), F.col("h").alias("hv"), F.col("w").alias("wv")), "v"))

    def compare(batches):
        for batch in batches:
            cols = {n: batch.column(n) for n in ("hu", "wu", "hv", "wv")}
            keep = []
            for i in range(batch.num_rows):
                hu, wu, hv, wv = (np.frombuffer(cols[n][i].as_buffer(), np.uint64 if n[0] == "h" else np.float32) for n in cols)
                keep.append(weighted_jaccard(hu, wu, hv, wv) >= similarity)
            kept = batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
            yield kept

    return met.select("u", "v", "hu", "wu", "hv", "wv").mapInArrow(compare, "u binary, v binary")


def _labelled(frame: DataFrame, labels: DataFrame | None, name: str) -> DataFrame:
    """``frame`` with the label of its column ``name`` as ``label_<name>``; a node without one is its own."""
    if labels is None:
        return frame.withColumn(f"label_{name}", F.col(name))
    known = labels.select(F.col("node").alias(name), F.col("label").alias("known"))
    return frame.join(known, name, "left").withColumn(f"label_{name}", F.coalesce("known", name)).drop("known")


def _apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs whose nodes are not in one class yet."""
    return _labelled(_labelled(pairs, labels, "u"), labels, "v").where("label_u != label_v")


class Links:
    """Classes of nodes as they grow by verified pairs."""

    def __init__(self, near: DataFrame, held: DataFrame, similarity: float):
        self.near, self.held, self.similarity = near, held, similarity
        self.labels: DataFrame | None = None
        self.tried: DataFrame | None = None

    def add(self, pairs: DataFrame, name: str, alike: bool = False) -> bool:
        """Verify the pairs of nodes that are in different classes and not tried yet; whether classes grew."""
        apart = _apart(pairs.select("u", "v").distinct(), self.labels)
        if self.tried is not None:
            apart = apart.join(self.tried, ["u", "v"], "left_anti")
        if not alike:
            apart = _apart(_alike(apart.select("u", "v"), self.near, LEAST_EQUAL), self.labels)
        fresh = staged(apart.select("u", "v", "label_u", "label_v"), f"pairs-{name}")
        if fresh.isEmpty():
            return False
        own = fresh.select("u", "v")
        self.tried = own if self.tried is None else self.tried.unionByName(own)
        found = _verified(own, self.held, self.similarity)
        edges = staged(found.join(fresh, ["u", "v"]).select(F.col("label_u").alias("u"), F.col("label_v").alias("v"))
                       .distinct(), f"edges-{name}")
        if edges.isEmpty():
            return False
        joined = connected_components(edges, f"classes-{name}")
        if self.labels is None:
            self.labels = joined
            return True
        moved = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))
        lifted = self.labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        new = joined.join(self.labels.select("node"), "node", "left_anti")
        self.labels = staged(lifted.unionByName(new), f"labels-{name}")
        return True


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    size: int = SHINGLE, rare: float = RARE) -> DataFrame:
    """``doc, row_a, row_b, class_id, class_size, kept``: each row's class; one row of each class is kept."""
    idf = docs.sparkSession.sparkContext.broadcast(idf_table(docs, text_col, size, rare))
    signed = staged(signatures(docs, idf, id_col, text_col, size), "signatures")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.first("samples").alias("samples"), F.first("bands").alias("bands"))
    nodes = staged(nodes, "nodes")
    # Most buckets have one node; what follows sees the nodes of the others only.
    every = nodes.select("node", F.explode("bands").alias("bucket"))
    several = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = staged(every.join(several, "bucket"), "buckets")
    close = staged(buckets.select("node").distinct(), "close")
    near = staged(nodes.join(close, "node"), "near")
    links = Links(near, _features(close, signed, docs, idf, id_col, text_col, size), similarity)

    stars = staged(_alike(_stars(buckets).distinct(), near, LEAST_EQUAL), "stars")
    # First each node with its smallest centre, then the other centres of nodes still apart from them.
    links.add(stars.groupBy("v").agg(F.min("u").alias("u")), "first", alike=True)
    links.add(stars, "other", alike=True)
    links.add(_second_level(near, buckets, links.labels), "second")
    _meet_rarest(links, buckets)
    return _classes(signed, links.labels)


def _mixed(known: DataFrame) -> DataFrame:
    """Buckets of more than two nodes that hold several classes; of two nodes, the star is the only pair."""
    return known.groupBy("bucket").agg(F.min("label_node").alias("low"), F.max("label_node").alias("high"),
                                       F.count("*").alias("n")).where("low != high AND n > 2").select("bucket")


def _second_level(nodes: DataFrame, buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Candidate pairs in buckets that hold several classes, by agreement in a second band."""
    mixed = _mixed(_labelled(buckets, labels, "node"))
    members = buckets.join(mixed, "bucket").join(nodes.select("node", "bands"), "node")
    parts = members.select("node", F.col("bucket").alias("own"), F.explode("bands").alias("more")).where("more != own")
    parts = parts.select("node", F.xxhash64(F.least("own", "more"), F.greatest("own", "more")).alias("bucket")).distinct()
    ends = parts.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    met = parts.join(ends, "bucket")
    return (met.where("node != low").select(F.col("low").alias("u"), F.col("node").alias("v"))
            .unionByName(met.where("node != high").select(F.col("node").alias("u"), F.col("high").alias("v")))).distinct()


# -- rarest shingles -------------------------------------------------------
def _shingle_counts(held: DataFrame) -> np.ndarray:
    """In how many of the nodes the shingles of each hash bucket occur; any one order of shingles serves the join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for h in batch.column(0):
                np.add.at(counts, (np.frombuffer(h.as_buffer(), np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["bucket", "n"])

    # As many rows as the table has buckets at most.
    found = held.select("h").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << BUCKET_BITS, np.int64)
    table[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return table


def rarest_keys(h: np.ndarray, w: np.ndarray, counts: np.ndarray, similarity: float) -> tuple[np.ndarray, ...]:
    """``key, left, right, rest, shingle`` of one text, ``rest`` being the weight from the shingle on, rarest first.

    A key names a shingle and two weight steps, one of them the text's own. For
    each step that a similar text may have, the text is found under the shingles
    that it may share first with a text of at least that step's weight.
    """
    order = np.lexsort((h, counts[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]))
    h, w = h[order], w[order].astype(np.float64)
    rest = np.cumsum(w[::-1])[::-1]
    step = lambda x: int(np.floor(np.log(x) / np.log(STEP)))
    own, parts = step(rest[0]), []
    for other in range(step(rest[0] * similarity * (1 - SLACK)), step(rest[0] / similarity * (1 + SLACK)) + 1):
        need = similarity / (1 + similarity) * (rest[0] + max(STEP ** other, similarity * rest[0])) * (1 - SLACK)
        n = int(np.searchsorted(-rest, -need, side="right"))
        low, high = min(own, other), max(own, other)
        with np.errstate(over="ignore"):
            name = np.uint64((low % (1 << 16)) << 16 | high % (1 << 16)) * np.uint64(0x9E3779B97F4A7C15)
            parts.append((_mix(h[:n] ^ name), np.full(n, own == low), np.full(n, own == high), rest[:n], h[:n]))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _rarest_rows(links: Links, buckets: DataFrame) -> DataFrame | None:
    """``key, left, right, node, total, rest, parts`` of the nodes of buckets that hold several classes, where a key
    is held by several classes."""
    similarity = links.similarity
    known = _labelled(buckets, links.labels, "node")
    members = staged(known.join(_mixed(known), "bucket").select("node", F.col("label_node").alias("label")).distinct(), "mixed")
    if members.isEmpty():
        return None
    held = links.held.join(members, "node")
    shared = members.sparkSession.sparkContext.broadcast(_shingle_counts(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        usual = 2 * int(counts.mean())
        for batch in batches:
            for i in range(batch.num_rows):
                h, w = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in ((2, np.uint64), (3, np.float32)))
                key, left, right, rest, shingle = rarest_keys(h, w, counts, similarity)
                often = counts[_bucket(shingle)]
                kept = often > 1
                n, total = int(kept.sum()), w.sum(dtype=np.float64)
                same = lambda c: pa.array([batch.column(c)[i].as_py()], pa.binary()).take(pa.array(np.zeros(n, np.int32)))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[kept].view(np.int64)), pa.array(left[kept]), pa.array(right[kept]), same(0), same(1),
                     pa.array(np.full(n, total)), pa.array(rest[kept]),
                     pa.array((1 + np.maximum(0, often[kept] - usual) // CROWD).astype(np.int32))],
                    names=["key", "left", "right", "node", "label", "total", "rest", "parts"])

    rows = held.select("node", "label", "h", "w").mapInArrow(
        run, "key long, left boolean, right boolean, node binary, label binary, total double, rest double, parts int")
    # Most keys are held by one class only.
    several = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")
    return staged(rows.join(several, "key", "left_semi").drop("label"), "rarest")


def _meet_rarest(links: Links, buckets: DataFrame) -> None:
    """Verify all pairs of different classes that may reach the threshold, among nodes of buckets that hold several classes."""
    rows = _rarest_rows(links, buckets)
    if rows is None:
        return
    # What a whole family shares is found by one text of it first, the one that has least beside it; so its
    # classes become one before classes meet each other. Keys that then hold several are few.
    for turn in range(CENTRES):
        if not links.add(_with_centres(rows, links), f"centre-{turn}"):
            break
    links.add(_all_shared(rows, links), "rarest")


def _still_mixed(rows: DataFrame, links: Links) -> DataFrame:
    known = _labelled(rows, links.labels, "node").withColumnRenamed("label_node", "label")
    several = known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")
    return known.join(several, "key", "left_semi")


def _reach(links: Links) -> float:
    """Share of two texts' weight that they have in common at the threshold."""
    return links.similarity / (1 + links.similarity) * (1 - SLACK)


def _with_centres(rows: DataFrame, links: Links) -> DataFrame:
    """``u, v``: the rows of each key with the row of another class that has the largest part of its weight from there on."""
    known = staged(_still_mixed(rows, links), "still-mixed")
    best = lambda frame, name: frame.groupBy("key").agg(F.max(F.struct(
        (F.col("rest") / F.col("total")).alias("share"), "node", "label", "total", "rest", "left", "right")).alias(name))
    one = best(known, "c")
    # The best row of another class than that of the key's best row serves the rows of that one.
    other = best(known.join(one.select("key", F.col("c.label").alias("first")), "key").where("label != first"), "o")
    met = (known.join(one, "key").join(other, "key")
           .withColumn("y", F.when(F.col("label") != F.col("c.label"), F.col("c")).otherwise(F.col("o"))))
    fits = ((F.col("left") & F.col("y.right")) | (F.col("right") & F.col("y.left"))) & (
        F.least("rest", "y.rest") >= (F.col("total") + F.col("y.total")) * _reach(links))
    return met.where(fits).select(F.least("node", "y.node").alias("u"), F.greatest("node", "y.node").alias("v"))


def _all_shared(rows: DataFrame, links: Links) -> DataFrame:
    """``u, v``: all pairs of rows of a key and of different classes that share enough from there on."""
    reach = _reach(links)
    # A class meets another in lists of bounded length; a key of many classes is dealt out over pairs of parts.
    lists = (_still_mixed(rows, links).groupBy("key", "left", "right", "label", "parts", F.expr("pmod(xxhash64(node), parts)").alias("part"))
             .agg(F.collect_list(F.struct("node", "total", "rest")).alias("held"), F.max("rest").alias("most"), F.min("total").alias("small"))
             .withColumn("cell", F.expr("cast(pmod(xxhash64(label), parts) AS int)")))
    every = F.explode(F.expr("sequence(0, parts - 1)"))
    us = lists.where("left").select("key", F.col("cell").alias("p"), every.alias("q"), F.col("right").alias("both"),
                                    F.col("label").alias("label_u"), F.col("held").alias("us"), F.col("most").alias("most_u"), F.col("small").alias("small_u"))
    vs = lists.where("right").select("key", every.alias("p"), F.col("cell").alias("q"), F.col("label").alias("label_v"),
                                     F.col("held").alias("vs"), F.col("most").alias("most_v"), F.col("small").alias("small_v"))
    # Lists that cannot hold a pair do not meet, and no row is made of a pair that does not reach.
    apart = (F.col("label_u") < F.col("label_v")) | (~F.col("both") & (F.col("label_u") != F.col("label_v")))
    reaches = F.least("most_u", "most_v") >= (F.col("small_u") + F.col("small_v")) * reach
    met = us.join(vs, (us["key"] == vs["key"]) & (us["p"] == vs["p"]) & (us["q"] == vs["q"]) & apart & reaches)
    met = met.select(F.explode(F.filter("us", lambda x: F.least(x["rest"], "most_v") >= (x["total"] + F.col("small_v")) * reach)).alias("x"), "vs")
    met = met.select("x", F.filter("vs", lambda y: F.least(F.col("x.rest"), y["rest"]) >= (F.col("x.total") + y["total"]) * reach).alias("ys"))
    pairs = met.where(F.size("ys") > 0).select("x", F.explode("ys").alias("y"))
    return pairs.select(F.least("x.node", "y.node").alias("u"), F.greatest("x.node", "y.node").alias("v"))


def _classes(signed: DataFrame, labels: DataFrame | None) -> DataFrame:
    rows = signed.select("doc", "row_a", "row_b", "node")
    named = _labelled(rows, labels, "node").withColumnRenamed("label_node", "label")
    alone = named.where("node IS NULL").select("doc", "row_a", "row_b", F.col("doc").alias("class_id"),
                                               F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    whole = named.where("node IS NOT NULL")
    first = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "row_a", "row_b")
    classes = whole.groupBy("label").agg(F.min(first).alias("first"), F.count("*").alias("class_size"))
    joined = whole.join(classes, "label").select(
        "doc", "row_a", "row_b", F.col("first.doc").alias("class_id"), "class_size",
        ((F.col("row_a") == F.col("first.row_a")) & (F.col("row_b") == F.col("first.row_b"))).alias("kept"))
    return joined.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
             size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each class.

    Of rows with the same id and text the one whose other columns come first, written as JSON, stays.
    """
    doc, text = F.col(quoted(id_col)), F.col(quoted(text_col)).cast("string")
    kept = near_duplicates(docs, id_col, text_col, similarity, size).where("kept").select("row_a", "row_b").distinct()
    columns = [F.col(quoted(c)) for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("row"), *row_key(doc, text))
    own = F.to_json(F.struct(*[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]))
    one = keyed.join(kept, ["row_a", "row_b"], "left_semi").groupBy("row_a", "row_b").agg(F.min_by("row", own).alias("row"))
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
