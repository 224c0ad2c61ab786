"""Language model scores by a hashed maximum-entropy model with a class-factored softmax.

A token's probability is that of its group of classes in its context, times
that of its class in the group and the context, times that of the token in its
class. Both softmaxes are log-linear in hashed features: the one, two and three
words before (skip features each by itself), the pair of the last two, and the
class four back. All features of
all words share ``ROWS`` rows of weights. Inside a class the only feature is the
token itself, whose maximum-entropy weights are the logarithms of its counts.

The most frequent words are classes of their own; the next ones, up to
``LEXICON`` words, are divided by the words they stand next to; all others are in
classes named by their ending. Each of those holds one unknown token besides,
so the probabilities of all known tokens and of the unknown ones sum to one.

Counts are of all training texts. Training is by rounds over disjoint parts of
them that together are all of them: a task takes gradient steps through its
texts from the shared weights, and what the tasks learnt is averaged row by
row, by how often each used the row. What a task hands on is bounded by the
weights, what is counted grows with the texts.

Texts are scored in batches of sparse rows. Counts of the words that fit no
bounded table are joined in, once for each text and distinct word; words so
frequent that such a join would be lopsided are in a bounded table of their own.

Cases: a null text is empty and has its end only; rows with a null id are not
learnt from and not held out; repeated rows are scored and learnt from each;
without training texts all tokens are unknown and all classes equally likely.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import SLICE, quoted
from tallywell.session import staged

#: Words with weights of their own place in the classes, other words whose counts are broadcast, words counted in memory.
LEXICON, OFTEN, HELD_WORDS = 1 << 17, 1 << 16, 400_000
#: Classes of one word, of words that stand in like places (a power of two), of other words by their ending.
SINGLE, GROUPED, ENDINGS = 31, 64, 16
#: Classes, the end's among them, in groups of so many.
CLASSES, WIDTH = SINGLE + GROUPED + ENDINGS + 1, 8
GROUPS = CLASSES // WIDTH
#: Rows of hashed features (a power of two), rows sent together, tokens in a gradient step.
ROWS, BLOCK, STEP = 1 << 13, 64, 4096
#: Directions of neighbour vectors; sixteenths of the training texts in each round; step size.
DIRECTIONS, ROUNDS, RATE = 8, (2, 14), 0.08
#: Largest score in size.
FAR = np.float32(35)
BACK = 4
#: Bytes of text whose tokens are looked up together.
CHUNK = 8 << 20


def chunks(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Whole slices of the batch, together of about ``CHUNK`` bytes in column ``text``."""
    size = pc.binary_length(batch.column(text)).to_numpy().astype(np.int64)
    first, held = 0, 0
    for at in range(0, batch.num_rows, SLICE):
        held += int(size[at:at + SLICE].sum())
        if held >= CHUNK or at + SLICE >= batch.num_rows:
            yield batch.slice(first, at + SLICE - first)
            first, held = at + SLICE, 0


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row, between spaces, tabs, line and page breaks, A-Z in lower case; how many each text has."""
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(bare)
    words, many = lists.flatten().cast(pa.binary()), pc.list_value_length(lists).to_numpy().astype(np.int64)
    blank = pc.binary_length(bare).to_numpy() == 0
    if blank.any():  # cut into one empty word
        words, many = words.filter(pc.greater(pc.binary_length(words), 0)), np.where(blank, 0, many)
    return words, many


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


@cache
def _ending_tables() -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([ending(k.to_bytes(n, "big")) for k in range(256 ** n)], np.int64) for n in (1, 2))


def endings(words: pa.Array) -> np.ndarray:
    """:func:`ending` of every word."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, offsets, data = words.buffers()
    bounds, data = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1], np.frombuffer(data, np.uint8)
    of_one, of_two = _ending_tables()
    last, before = data[bounds[1:] - 1], data[bounds[1:] - 2].astype(np.int64)
    return np.where(np.diff(bounds) > 1, of_two[before * 256 + last], of_one[last])


# -- model -----------------------------------------------------------------
@dataclass
class Vocabulary:
    """Lexicon and often seen words; after them the endings, the end and the start as entries of their own."""

    words: list[bytes]
    counts: np.ndarray  # of the words in training texts
    lexicon: int
    tokens: int  # N
    distinct: int  # V
    ends: int
    classes: np.ndarray | None = None  # of every entry
    mass: np.ndarray | None = None  # of every class, unknown ones included

    def __post_init__(self):
        self.table = pa.array(self.words, pa.binary())
        self.first_ending = len(self.words)
        self.end = self.first_ending + ENDINGS
        self.start = self.end + 1
        held = np.concatenate((self.counts, np.zeros(ENDINGS), [self.ends, 0]))
        self.log_count = np.log10(held + 0.5)
        self.log_count[self.first_ending:self.end] = 0  # joined in later
        self.known = held > 0

    @property
    def divisor(self) -> float:
        return float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))

    @cached_property
    def place(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def ids(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        """Entries of the text's tokens with starts before and the end behind, and its words that have no entry."""
        found = self.entries(pa.array([text], pa.string()))
        return found.ids, found.rare.to_pylist()

    def entries(self, texts: pa.Array) -> Entries:
        words, many = cut(texts)
        own = pc.fill_null(pc.index_in(words, value_set=self.table), -1).to_numpy().astype(np.int64)
        at = np.flatnonzero(own < 0)
        rare = words.take(pa.array(at))
        own[at] = self.first_ending + endings(rare)
        last = np.cumsum(many + BACK + 1) - 1
        ids, words_at = np.full(len(own) + len(many) * (BACK + 1), self.start, np.int64), np.ones(len(own) + len(many) * (BACK + 1), bool)
        words_at[last] = False
        words_at[((last - many - BACK)[:, None] + np.arange(BACK)).ravel()] = False
        ids[words_at], ids[last] = own, self.end
        words_at[last] = True
        return Entries(ids, np.flatnonzero(words_at), many + 1, rare, np.repeat(np.arange(len(many)), many)[at])


@dataclass
class Entries:
    """Entries of texts in a row, starts before and the end behind each."""

    ids: np.ndarray
    at: np.ndarray  # places of the tokens
    sizes: np.ndarray  # tokens of each text
    rare: pa.Array  # words without entry
    rare_in: np.ndarray  # the text of each of them

    def rare_counts(self) -> tuple[pa.ListArray, pa.ListArray]:
        """Per text the distinct words without entry, and how often it holds each."""
        found = self.rare.dictionary_encode()
        key, times = np.unique(self.rare_in * len(found.dictionary) + found.indices.to_numpy(), return_counts=True)
        text, word = np.divmod(key, max(len(found.dictionary), 1))
        bounds = pa.array(np.searchsorted(text, np.arange(len(self.sizes) + 1)).astype(np.int32))
        return (pa.ListArray.from_arrays(bounds, found.dictionary.take(pa.array(word))),
                pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))))

    def steps(self) -> Iterator[np.ndarray]:
        """Places of up to ``STEP`` tokens, none of two slices of texts."""
        ends = np.cumsum(self.sizes)
        first = 0
        for stop in [*ends[SLICE - 1:-1:SLICE].tolist(), len(self.at)]:
            for a in range(first, stop, STEP):
                yield self.at[a:min(a + STEP, stop)]
            first = stop


def _row(feature: int, key: np.ndarray) -> np.ndarray:
    """The feature's row of weights for each key."""
    x = key.astype(np.uint64)
    x += np.uint64((feature + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for odd in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> np.uint64(33)
        x *= np.uint64(odd)
    x ^= x >> np.uint64(33)
    x &= np.uint64(ROWS - 1)
    return x.view(np.int64)


class Features:
    """Rows of weights; those of features with few keys are worked out once."""

    def __init__(self, classes: np.ndarray):
        every, near = np.arange(len(classes)), np.arange(CLASSES)
        pair = (near[:, None] * (1 << 24) + near).ravel()
        self.classes = classes
        self.word = [_row(k, every).astype(np.min_scalar_type(ROWS)) for k in range(3)]
        self.near, self.far, self.last = _row(4, pair), _row(5, pair), _row(6, near)

    def rows(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each feature the row of weights of every place."""
        word = [ids.take(at - k) for k in range(1, BACK + 1)]
        near = [self.classes.take(w) for w in word]
        return np.stack([*[own.take(w) for own, w in zip(self.word, word)], _row(3, word[0] * (1 << 24) + word[1]),
                         self.near.take(near[0] * CLASSES + near[1]), self.far.take(near[2] * CLASSES + near[3]), self.last.take(near[3])])


def feature_rows(ids: np.ndarray, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each feature the row of weights of every place."""
    return Features(classes).rows(ids, at)


class Weights:
    """Rows of weights: ``w`` for the groups of classes, ``v`` for the classes of each group; the last row is added everywhere."""

    def __init__(self):
        self.w = np.zeros((ROWS + 1, GROUPS), np.float32)
        self.v = np.zeros((ROWS + 1, GROUPS, WIDTH), np.float32)
        # Sums of mean squared gradients so far.
        self.w_slope = np.zeros(ROWS + 1, np.float32)
        self.v_slope = np.zeros((ROWS + 1, GROUPS), np.float32)

    def shares(self, rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the groups, and of the classes of the group of each place."""
        by_group, by_class = self.w[ROWS] + self.w.take(rows[0], axis=0), self.v[ROWS].take(group, axis=0)
        flat = self.v.reshape(-1, WIDTH)
        more_group, more_class = np.empty_like(by_group), np.empty_like(by_class)
        for k, row in enumerate(rows):
            if k:
                by_group += self.w.take(row, axis=0, out=more_group, mode="clip")
            by_class += flat.take(row * GROUPS + group, axis=0, out=more_class, mode="clip")
        for score in (by_group, by_class):
            # Far beyond what weights reach, and still a number as an exponential.
            np.clip(score, -FAR, FAR, out=score)
            np.exp(score, out=score)
            score /= (score @ np.ones(score.shape[1], np.float32))[:, None]
        return by_group, by_class

    def log_share(self, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each place's class."""
        by_group, by_class = self.shares(rows, target // WIDTH)
        place = np.arange(len(target))
        return np.log(by_group[place, target // WIDTH].astype(float) * by_class[place, target % WIDTH])

    def learn(self, rows: np.ndarray, target: np.ndarray, rate: float = RATE) -> None:
        """One gradient step."""
        group, place = target // WIDTH, np.arange(len(target))
        gaps = self.shares(rows, group)
        gaps[0].reshape(-1)[place * GROUPS + group] -= 1
        gaps[1].reshape(-1)[place * WIDTH + target % WIDTH] -= 1
        flat = np.concatenate((rows.ravel(), np.full(len(target), ROWS)))
        _step(self.w, self.w_slope, flat, gaps[0], rate)
        _step(self.v.reshape(-1, WIDTH), self.v_slope.reshape(-1), flat * GROUPS + np.tile(group, len(rows) + 1), gaps[1], rate)


def _step(weights: np.ndarray, slopes: np.ndarray, rows: np.ndarray, gap: np.ndarray, rate: float) -> None:
    """Take a step in the rows named; each place's gap counts for all of its rows, which follow feature by feature."""
    times, each = len(rows) // len(gap), gap.T.astype(float, order="C")
    if len(weights) < len(rows):
        used, at, many = slice(None), rows, len(weights)
    else:
        met, place = np.zeros(len(weights), bool), np.empty(len(weights), np.int64)
        met[rows] = True
        used = np.flatnonzero(met)
        many = len(used)
        place[used] = np.arange(many)
        at = place.take(rows)
    slope, held = np.empty((many, len(each)), np.float32), np.empty((times, len(gap)))
    for c, own in enumerate(each):
        held[:] = own
        slope[:, c] = np.bincount(at, held.ravel(), many)
    slopes[used] += np.einsum("ij,ij->i", slope, slope) / np.float32(len(each))
    slope *= (np.float32(rate) / np.sqrt(slopes[used] + np.float32(1e-6)))[:, None]
    if len(weights) < len(rows):
        weights -= slope
    else:
        # Rows as one value each, which is put faster than as many.
        fresh, whole = weights.take(used, axis=0) - slope, np.dtype((np.void, 4 * len(each)))
        np.put(weights.view(whole), used, fresh.view(whole))


# -- counts ----------------------------------------------------------------
def trained_on(doc):
    """Whether a row is learnt from, null for a null id, and whether it is held out."""
    left = F.pmod(F.crc32(doc.cast("string").cast("binary")), F.lit(5))
    return F.coalesce(left != 1, F.lit(False)), F.coalesce(left == 1, F.lit(False))


def _summed(tables: list[pa.Table]) -> pa.Table:
    if len(tables) == 1:
        return tables[0]
    out = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("c", "sum"), ("t", "sum")])
    return out.select(["word", "c_sum", "t_sum"]).rename_columns(["word", "c", "t"])


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, ending, c, t`` of the ``learn, text`` of one task; a word may come again."""
    held, learnt, ends = [], 0, 0

    def told(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for part in table.combine_chunks().to_batches():
            word, c, t = part.columns
            yield pa.RecordBatch.from_arrays([word, pa.array(endings(word).astype(np.int32)), c, t], names=["word", "ending", "c", "t"])

    for batch in batches:
        for part in chunks(batch, 1):
            learn = part.column(0).to_numpy(zero_copy_only=False)
            words, many = cut(part.column(1))
            learnt, ends = learnt + int(learn.sum()), ends + len(learn)
            found = words.dictionary_encode()
            at, size = found.indices.to_numpy(), len(found.dictionary)
            held.append(pa.table([found.dictionary, pa.array(np.bincount(at[np.repeat(learn, many)], minlength=size)),
                                  pa.array(np.bincount(at, minlength=size))], names=["word", "c", "t"]))
            if sum(map(len, held)) > HELD_WORDS:
                held = [_summed(held)]
                if len(held[0]) > HELD_WORDS // 2:
                    yield from told(held.pop())
    if held:
        yield from told(_summed(held))
    if ends:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), pa.array([-1], pa.int32()), pa.array([learnt]), pa.array([ends])],
                                         names=["word", "ending", "c", "t"])


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, ending, c, t`` over ``learn, text``: counts in training and in all texts; the word null counts ends."""
    return (texts.select("learn", "text").mapInArrow(counted, "word binary, ending int, c long, t long")
            .groupBy("word", "ending").agg(F.sum("c").alias("c"), F.sum("t").alias("t")))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0),
                       F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("c"))), F.lit(0))).first()
    words = counts.where("word IS NOT NULL")
    # Both tables have a stated number of rows.
    lexicon = words.where("c > 0").orderBy(F.col("c").desc(), "word").limit(LEXICON).select("word", "c").toArrow()
    often = words.orderBy(F.col("t").desc(), "word").limit(OFTEN).select("word", "c").toArrow()
    own = dict(zip(lexicon.column(0).to_pylist(), lexicon.column(1).to_pylist()))
    for w, c in zip(often.column(0).to_pylist(), often.column(1).to_pylist()):
        own.setdefault(w, c)
    return Vocabulary(list(own), np.array(list(own.values()), np.int64), lexicon.num_rows, total[0], total[1], total[2])


# -- classes ---------------------------------------------------------------
def neighbour_vectors(texts: DataFrame, vocab) -> np.ndarray:
    """Per lexicon word the sum of random signs that its neighbours have, over all training texts."""
    size = vocab.value.lexicon
    names = [f"s{d}" for d in range(DIRECTIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocab.value
        signs = np.zeros((own.start + 1, DIRECTIONS), np.int8)
        signs[:size] = np.random.default_rng(3).integers(0, 2, (size, DIRECTIONS)) * 2 - 1
        sums = np.zeros((DIRECTIONS, size), np.int64)
        for batch in batches:
            for part in chunks(batch, 0):
                ids = own.entries(part.column(0)).ids
                place = np.flatnonzero(ids[1:-1] < size) + 1
                near, at = signs[ids[place - 1]] + signs[ids[place + 1]], ids[place]
                for d in range(DIRECTIONS):
                    sums[d] += np.bincount(at, near[:, d], size).astype(np.int64)
        held = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(held), *[pa.array(s[held]) for s in sums]], names=["id", *names])

    found = (texts.where("learn").select("text").mapInArrow(run, ", ".join(["id long", *[f"{n} long" for n in names]]))
             .groupBy("id").agg(*[F.sum(n).alias(n) for n in names])).toArrow()  # one row per lexicon word
    out = np.zeros((size, DIRECTIONS))
    out[found.column("id").to_numpy()] = np.stack([found.column(n).to_numpy() for n in names], axis=1)
    return out


def grouped(vectors: np.ndarray, counts: np.ndarray, parts: int) -> np.ndarray:
    """Divide words into groups of like mass, each time across the direction in which they differ most."""
    at = vectors / (2 * np.maximum(counts, 1))[:, None] if len(vectors) else vectors
    group = np.zeros(len(at), np.int64)
    while parts > 1:
        fresh = group * 2
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            weight = counts[own] / counts[own].sum()
            middle = at[own] - weight @ at[own]
            _, axes = np.linalg.eigh((middle * weight[:, None]).T @ middle)
            order = np.argsort(middle @ axes[:, -1], kind="stable")
            share = np.cumsum(weight[order])
            fresh[own[order[share - weight[order] / 2 > 0.5]]] += 1
        group, parts = fresh, parts // 2
    return group


def with_classes(vocab: Vocabulary, vectors: np.ndarray, ending_mass: np.ndarray) -> Vocabulary:
    """Give every entry a class and every class its mass; ``ending_mass`` is that of all words with a count."""
    classes = np.zeros(vocab.start + 1, np.int64)
    size, single = vocab.lexicon, min(SINGLE, vocab.lexicon)
    # Classes of like words follow each other, so they share a group.
    order = np.argsort(grouped(vectors[:single], vocab.counts[:single], 4), kind="stable")
    classes[order] = GROUPED + np.arange(single)
    classes[single:size] = grouped(vectors[single:], vocab.counts[single:size], GROUPED)
    first = SINGLE + GROUPED
    classes[size:vocab.first_ending] = [first + ending(w) for w in vocab.words[size:]]
    classes[vocab.first_ending:vocab.end] = first + np.arange(ENDINGS)
    classes[vocab.end:] = CLASSES - 1
    held = vocab.counts[:size] + 0.5
    mass = np.bincount(classes[:size], held, CLASSES)
    own_endings = np.bincount([ending(w) for w in vocab.words[:size]], held, ENDINGS) if size else np.zeros(ENDINGS)
    mass[first:first + ENDINGS] = np.maximum(ending_mass - own_endings, 0) + 0.5
    mass[CLASSES - 1] = vocab.ends + 0.5
    vocab.classes, vocab.mass = classes, np.where(mass > 0, mass, 1.0)
    return vocab


# -- training --------------------------------------------------------------
def _packed(weights: Weights) -> np.ndarray:
    """Per row all weights and slopes."""
    return np.concatenate((weights.w, weights.v.reshape(ROWS + 1, -1), weights.w_slope[:, None], weights.v_slope), axis=1)


def _unpacked(table: np.ndarray) -> Weights:
    out, ends = Weights(), np.cumsum([GROUPS, CLASSES, 1])
    w, v, w_slope, v_slope = np.split(table, ends, axis=1)
    out.w, out.v, out.w_slope, out.v_slope = w.copy(), v.reshape(out.v.shape).copy(), w_slope[:, 0].copy(), v_slope.copy()
    return out


def train_round(texts: DataFrame, vocab, weights: Weights) -> Weights:
    """Weights after one pass over ``text``: each task's, averaged by use."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)
    blocks = -(-(ROWS + 1) // BLOCK)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = _unpacked(_packed(shared.value)), vocab.value
        features, used = Features(words.classes), np.zeros(blocks * BLOCK, np.int64)
        for batch in batches:
            for part in chunks(batch, 0):
                found = words.entries(part.column(0))
                for at in found.steps():
                    rows = features.rows(found.ids, at)
                    own.learn(rows, words.classes[found.ids[at]])
                    used += np.bincount(rows.ravel(), minlength=len(used))
                    used[ROWS] += len(at)
        table = _packed(own) * used[:ROWS + 1, None]
        told = np.zeros((len(used), table.shape[1] + 1), np.float32)
        told[:, 0], told[:ROWS + 1, 1:] = used, table
        told = told.reshape(blocks, BLOCK, -1)
        some = np.flatnonzero(told[:, :, 0].any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([told[b].tobytes() for b in some], pa.binary())],
                                         names=["block", "told"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, told in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = np.frombuffer(told.as_buffer(), np.float32).astype(float)
                sums[b] = sums[b] + row if b in sums else row
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                         names=["block", "told"])

    schema = "block int, told binary"
    # As many rows as the weights have blocks.
    found = texts.mapInArrow(learn, schema).repartition(min(blocks, 32), "block").mapInArrow(merge, schema).collect()
    shared.unpersist()
    out = _packed(weights)
    for row in found:
        told = np.frombuffer(row.told, float).reshape(BLOCK, -1)
        n = np.flatnonzero(told[:, 0])
        out[row.block * BLOCK + n] = told[n, 1:] / told[n, :1]
    return _unpacked(out)


@dataclass
class Model:
    vocab: object  # broadcast of the vocabulary
    weights: object  # broadcast of the weights
    counts: DataFrame


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the rows whose id's crc32 is not 1 modulo 5."""
    sc = docs.sparkSession.sparkContext
    doc = F.col(quoted(id_col))
    texts = docs.select(trained_on(doc)[0].alias("learn"), F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"),
                        F.pmod(F.xxhash64(doc), F.lit(16)).alias("part"))
    counts = staged(word_counts(texts), "lm-counts")
    held = vocabulary(counts)
    mass = {r.ending: r.mass for r in counts.where("c > 0 AND word IS NOT NULL").groupBy("ending").agg(F.sum(F.col("c") + 0.5).alias("mass")).collect()}
    vectors = neighbour_vectors(texts, sc.broadcast(held))
    vocab = sc.broadcast(with_classes(held, vectors, np.array([float(mass.get(k, 0)) for k in range(ENDINGS)])))
    weights = Weights()
    share = np.bincount(held.classes[:held.lexicon], held.counts[:held.lexicon], CLASSES)
    share[SINGLE + GROUPED:] = held.mass[SINGLE + GROUPED:]
    if held.tokens:
        by_group = (share + 1).reshape(GROUPS, WIDTH)
        weights.w[ROWS] = np.log(by_group.sum(axis=1) / by_group.sum())
        weights.v[ROWS] = np.log(by_group / by_group.sum(axis=1, keepdims=True))
    first = 0
    for n in ROUNDS:
        own = texts.where(F.col("learn") & F.col("part").between(first, first + n - 1)).select("text")
        weights, first = train_round(own, vocab, weights), first + n
    return Model(vocab, sc.broadcast(weights), counts)


# -- scores ----------------------------------------------------------------
def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``."""
    doc = F.col(quoted(id_col))
    source = docs.select(F.monotonically_increasing_id().alias("row"), doc.alias("id"), trained_on(doc)[1].alias("held_out"),
                         F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    names = ["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"]
    shared_vocab, shared_weights = model.vocab, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights = shared_vocab.value, shared_weights.value
        features, log_mass = Features(vocab.classes), np.log10(vocab.mass)
        for batch in batches:
            for part in chunks(batch, 3):
                found = vocab.entries(part.column(3))
                told = [np.empty(0)]
                for at in found.steps():
                    target = vocab.classes[found.ids[at]]
                    told.append(weights.log_share(features.rows(found.ids, at), target) / np.log(10) - log_mass[target])
                sizes, own = found.sizes, found.ids[found.at]
                first = np.cumsum(sizes) - sizes
                log_count = vocab.log_count[own]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(3)], pa.array(sizes), pa.array(np.add.reduceat(vocab.known[own].astype(np.int64), first)),
                     pa.array(np.add.reduceat(log_count, first) - sizes * vocab.divisor),
                     pa.array(np.add.reduceat(np.concatenate(told) + log_count, first)), *found.rare_counts()],
                    names=names)

    scored = staged(source.mapInArrow(run, f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base double, "
                                           "score double, rare array<binary>, times array<int>"), "lm-scored")
    # Words of the two bounded tables are not here, so no word is a hot key.
    words = scored.where(F.size("rare") > 0).select("row", F.inline(F.arrays_zip("rare", "times")))
    met = words.join(model.counts.where("c > 0").select(F.col("word").alias("rare"), "c"), "rare", "left")
    added = met.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("log_counts"),
                                   F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"))
    more = F.coalesce("log_counts", F.lit(0.0))
    return scored.drop("rare", "times").join(added, "row", "left").select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.vocab.value.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"))
