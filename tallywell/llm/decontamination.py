"""Benchmark decontamination: BM25 index of the test items, block-max WAND, overlap check.

The test items are indexed; every passage of every training document is a
query. A passage is two neighbouring cells of as many words as the longest
item, so any place an item could take lies whole in some passage. The weights
of an item are divided by its score against itself, so a passage that holds
all its words scores 1 and one threshold serves items of any length.

Retrieval is exact above the threshold: a passage that no range of items can
lift to it is passed over, and for the others lists are walked by block-max
WAND. A retrieved item counts as leaked if its question and its answer both
overlap the document's words in order.

The items are indexed in blocks of at most ``ITEM_BLOCK``; a block is all that
is ever broadcast, and the documents stay where they lie. Document frequencies
and the mean length are those of all items.

Cases: null or empty texts leak nothing; an item without a word is never found;
repeated items are found each; rows are judged one by one, so repeated rows get
the same result; a document may leak several items.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import SLICE, quoted

K1, B = 1.2, 0.75
#: Least share of an item's own score, and least share of its question's and answer's word runs.
THRESHOLD, OVERLAP = 0.5, 0.5
#: Words of a run in the question and in the answer.
QUESTION_RUN, ANSWER_RUN = 5, 3
ITEM_BLOCK, POSTING_BLOCK = 20_000, 16
#: Item ranges for which passages are bounded before lists are walked.
GRID = 64

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?。？！])\s+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer: the last sentence, or the last third of a single one."""
    parts = [w for w in map(words_of, SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def runs(words: list[str], size: int) -> set[tuple[str, ...]]:
    size = max(1, min(size, len(words)))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


@dataclass
class Leak:
    item: int
    score: float
    question: float
    answer: float


class ItemIndex:
    """Posting lists of normalised BM25 weights, in blocks with their largest weight."""

    def __init__(self, items: list[tuple[list[str], list[str]]], frequency: dict[str, int], total: int, mean: float,
                 threshold: float = THRESHOLD):
        self.threshold = threshold
        self.question = [runs(q, QUESTION_RUN) for q, _ in items]
        self.answer = [runs(a, ANSWER_RUN) for _, a in items]
        self.longest = max((len(q) + len(a) for q, a in items), default=1) or 1
        lists: dict[str, list[tuple[int, float]]] = {}
        for k, (q, a) in enumerate(items):
            words = q + a
            weights = {}
            for w in set(words):
                n = frequency[w]
                idf = math.log(1 + (total - n + 0.5) / (n + 0.5))
                tf = words.count(w)
                weights[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            own = sum(weights.values())
            for w, weight in weights.items():
                lists.setdefault(w, []).append((k, weight / own))
        self.term = {w: i + 1 for i, w in enumerate(lists)}
        self.lists = [([], [])] + [tuple(map(list, zip(*p))) for p in lists.values()]
        self.block_max = [[max(ws[i:i + POSTING_BLOCK]) for i in range(0, len(ws), POSTING_BLOCK)] for _, ws in self.lists]
        self.block_end = [[ds[min(i + POSTING_BLOCK, len(ds)) - 1] for i in range(0, len(ds), POSTING_BLOCK)]
                          for ds, _ in self.lists]
        self.top = np.array([max(m, default=0.0) for m in self.block_max])
        # The same bounds on a common grid of item ranges, to bound many passages at once.
        width = max(1, -(-len(items) // GRID))
        self.ranges = -(-len(items) // width) or 1
        grid: list[dict[int, float]] = [{} for _ in self.lists]
        for t, (docs, ws) in enumerate(self.lists):
            for d, w in zip(docs, ws):
                grid[t][d // width] = max(w, grid[t].get(d // width, 0.0))
        self.grid_count = np.array([len(g) for g in grid])
        self.grid_start = np.cumsum(self.grid_count) - self.grid_count
        self.grid_range = np.array([r for g in grid for r in g], np.int64)
        self.grid_max = np.array([w for g in grid for w in g.values()])

    # -- one passage -------------------------------------------------------
    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items that score at least the threshold, by block-max WAND."""
        need, found = self.threshold - 1e-9, []
        cursors = [[self.lists[t][0][0], 0, t] for t in terms]
        while cursors:
            cursors.sort()
            reach, pivot = 0.0, -1
            for n, (_, _, t) in enumerate(cursors):
                reach += self.top[t]
                if reach >= need:
                    pivot = n
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            reach, until = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else 1 << 60
            for _, at, t in cursors[:pivot + 1]:
                ends, block = self.block_end[t], at // POSTING_BLOCK
                while block < len(ends) and ends[block] < item:
                    block += 1
                if block < len(ends):
                    reach += self.block_max[t][block]
                    until = min(until, ends[block] + 1)
            if reach < need:
                cursors = self._advance(cursors, pivot, max(until, item + 1))
            elif cursors[0][0] == item:
                score = sum(self.lists[t][1][at] for _, at, t in cursors[:pivot + 1])
                if score >= need:
                    found.append((item, score))
                cursors = self._advance(cursors, pivot, item + 1)
            else:
                cursors = self._advance(cursors, pivot, item)
        return found

    def _advance(self, cursors, pivot, item):
        """Move the lists up to the pivot to their first posting at or behind the item, block by block."""
        kept = cursors[pivot + 1:]
        for _, at, t in cursors[:pivot + 1]:
            ends, docs = self.block_end[t], self.lists[t][0]
            block = at // POSTING_BLOCK
            while block < len(ends) and ends[block] < item:
                block += 1
                at = block * POSTING_BLOCK
            while at < len(docs) and docs[at] < item:
                at += 1
            if at < len(docs):
                kept.append([docs[at], at, t])
        return kept

    # -- texts -------------------------------------------------------------
    def leaks(self, texts: list[str]) -> list[list[Leak]]:
        """Leaked items of each text."""
        out: list[list[Leak]] = [[] for _ in texts]
        if len(self.lists) == 1:
            return out
        get, size = self.term.get, self.longest
        split = [words_of(t) for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        terms = np.fromiter((get(w, 0) for words in split for w in words), np.int32, int(lengths.sum()))
        # Cells of ``size`` words, and an empty one at the end of each text.
        counts = -(-lengths // size) + 1
        first_cell = np.cumsum(counts) - counts
        first_word = np.cumsum(lengths) - lengths
        at = np.flatnonzero(terms)
        owner = np.repeat(np.arange(len(split)), lengths)[at]
        cell = first_cell[owner] + (at - first_word[owner]) // size
        terms = terms[at]
        need, cells = self.threshold - 1e-9, int(counts.sum())
        hot = self._reach(np.bincount(cell, self.top[terms], cells), need)[cell]
        pairs = np.unique(cell[hot] * len(self.lists) + terms[hot])
        cell, terms = pairs // len(self.lists), pairs % len(self.lists)
        bound = self._bounds(cell, terms, cells)
        passage = np.flatnonzero((bound[:-1] + bound[1:]).max(axis=1) >= need)
        passage = passage[~np.isin(passage, first_cell[1:] - 1)]
        # A term in both cells of a passage counts once.
        edges = np.searchsorted(cell, np.arange(cells + 1))
        sizes = edges[passage + 2] - edges[passage]
        entry = np.arange(int(sizes.sum())) + np.repeat(edges[passage] - (np.cumsum(sizes) - sizes), sizes)
        pairs = np.unique(np.repeat(np.arange(len(passage)), sizes) * len(self.lists) + terms[entry])
        of, terms = pairs // len(self.lists), pairs % len(self.lists)
        edges = np.searchsorted(of, np.arange(len(passage) + 1))
        for n in np.flatnonzero(self._bounds(of, terms, len(passage)).max(axis=1) >= need).tolist():
            p = int(passage[n])
            doc = int(np.searchsorted(first_cell, p, side="right")) - 1
            hits = self.retrieve(terms[edges[n]:edges[n + 1]].tolist())
            if hits:
                self._verify(split[doc], (p - int(first_cell[doc])) * size, hits, out[doc])
        return [self._best(found) for found in out]

    def _bounds(self, group: np.ndarray, terms: np.ndarray, groups: int) -> np.ndarray:
        """For each group of distinct terms and range of items, a bound on the items' scores."""
        many = self.grid_count[terms]
        entry = np.arange(int(many.sum())) + np.repeat(self.grid_start[terms] - (np.cumsum(many) - many), many)
        return np.bincount(np.repeat(group, many) * self.ranges + self.grid_range[entry], self.grid_max[entry],
                           groups * self.ranges).reshape(groups, self.ranges)

    @staticmethod
    def _reach(bound: np.ndarray, need: float) -> np.ndarray:
        """Cells that lie in a passage which may score enough."""
        passes = np.concatenate((bound[:-1] + bound[1:] >= need, [False]))
        return passes | np.concatenate(([False], passes[:-1]))

    def _verify(self, words, start, hits, found):
        window = words[start:start + 2 * self.longest]
        held: dict[int, set] = {}
        for item, score in hits:
            share = []
            for part in (self.question[item], self.answer[item]):
                n = len(next(iter(part), ()))
                if n and n not in held:
                    held[n] = runs(window, n) if len(window) >= n else set()
                share.append(len(part & held[n]) / len(part) if part else 1.0)
            if min(share) >= OVERLAP:
                found.append(Leak(item, score, *share))

    @staticmethod
    def _best(found: list[Leak]) -> list[Leak]:
        kept: dict[int, Leak] = {}
        for leak in found:
            if leak.item not in kept or (leak.score, leak.question) > (kept[leak.item].score, kept[leak.item].question):
                kept[leak.item] = leak
        return [kept[k] for k in sorted(kept)]


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, question, answer`` (words) of the items that have a word."""
    source = items.select(F.col(quoted(id_col)).cast("long"), F.col(quoted(text_col)).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_item(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([q for q, _ in parts], pa.list_(pa.string())),
                                              pa.array([a for _, a in parts], pa.list_(pa.string()))],
                                             names=["item", "question", "answer"])

    return source.mapInArrow(run, "item long, question array<string>, answer array<string>").where("size(question) > 0")


def _blocks(items: DataFrame, size: int) -> Iterator[tuple[list, list, dict, int, float]]:
    """Blocks of items with the statistics of all items: ids, words, frequencies, number, mean length."""
    words = F.concat("question", "answer")
    total, mean = items.agg(F.count("*"), F.avg(F.size(words))).first()
    frequency = items.select(F.explode(F.array_distinct(words)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    blocks = -(-total // size)
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("question", "answer"), F.lit(blocks)) == b)
        rows = own.orderBy("item", "question", "answer").collect()
        mine = frequency if blocks == 1 else frequency.join(own.select(F.explode(words).alias("w")).distinct(), "w", "left_semi")
        yield ([r.item for r in rows], [(r.question, r.answer) for r in rows], {r.w: r.n for r in mine.collect()},
               total, mean)


#: Indexes that a worker has built, the last few; its tasks share them.
BUILT: dict[str, ItemIndex] = {}


def _built(name: str, shared) -> ItemIndex:
    if name not in BUILT:
        while len(BUILT) > 1:
            BUILT.pop(next(iter(BUILT)))
        BUILT[name] = ItemIndex(*shared.value)
    return BUILT[name]


def _indexes(items: DataFrame, id_col: str, text_col: str, threshold: float, block: int) -> Iterator[tuple[list, Callable]]:
    """Per block of items their ids and a function that gives its index in a task."""
    sc = items.sparkSession.sparkContext
    for ids, words, frequency, total, mean in _blocks(item_words(items, id_col, text_col), block):
        shared, name = sc.broadcast((words, frequency, total, mean, threshold)), uuid.uuid4().hex
        yield ids, lambda shared=shared, name=name: _built(name, shared)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
               block: int = ITEM_BLOCK) -> DataFrame:
    """``id, item, score, question, answer``: the leaked items of every document."""
    source = docs.select(F.col(quoted(id_col)), F.col(quoted(text_col)).cast("string"))
    kind = source.schema[id_col].dataType.simpleString()
    names = ["id", "item", "score", "question", "answer"]
    ddl = f"id {kind}, item long, score double, question double, answer double"
    found = docs.sparkSession.createDataFrame([], ddl)
    for ids, index in _indexes(items, item_col, item_text_col, threshold, block):
        def run(batches, ids=ids, index=index):
            own = index()
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    leaks = own.leaks([t or "" for t in part.column(1).to_pylist()])
                    rows = [(i, leak) for i, found in enumerate(leaks) for leak in found]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array([i for i, _ in rows], pa.int64())),
                         pa.array([ids[x.item] for _, x in rows], pa.int64()),
                         *[pa.array([getattr(x, n) for _, x in rows], pa.float64()) for n in names[2:]]], names=names)
        found = found.unionByName(source.mapInArrow(run, ddl))
    return found


def drop_leaked(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                item_text_col: str = "text", threshold: float = THRESHOLD, block: int = ITEM_BLOCK) -> DataFrame:
    """The documents without a leaked item, all columns as they are."""
    place = docs.columns.index(text_col)
    for _, index in _indexes(items, item_col, item_text_col, threshold, block):
        def run(batches, index=index):
            own = index()
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    leaks = own.leaks([t or "" for t in part.column(place).to_pylist()])
                    yield part.filter(pa.array([not found for found in leaks], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
