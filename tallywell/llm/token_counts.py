"""Token counts of whole texts by rank-synchronous array merging.

Distinct pre-tokens lie one after the other in flat arrays. In each round every
pre-token merges its pair of lowest rank, all pre-tokens at once, until no pair
is left; the symbols that survive are counted.

A piece never has a space after another character, so no merge crosses the
start of a word and words can be merged apart. Runs of spaces have pieces of
their own, all of the same rank, and merge after everything else; they are
counted from the run's length.

Cases: a null or empty text has no token; a character without a piece counts
its UTF-8 bytes; U+2581 in a text is a space to the model; repeated rows are
counted each.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import map_texts

SPACE = "▁"
NONE = np.int32(2**31 - 1)
#: Words whose counts a Python worker remembers, and the longest of them.
MEMO_WORDS, MEMO_LENGTH = 250_000, 64
#: Words merged in one set of arrays.
BLOCK_WORDS = 20_000
ALONE = 1 << 40


class PairTable:
    """Ranks of symbol pairs in an open-addressed numpy table."""

    def __init__(self, pairs: dict[tuple[int, int], int], symbols: int):
        self.symbols = symbols
        keys = np.array([a * symbols + b for a, b in pairs], np.int64)
        ranks = np.array(list(pairs.values()), np.int32)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        self.mask = (1 << bits) - 1
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] == -1
            spots, first = np.unique(slots[left[free]], return_index=True)
            placed = left[free][first]
            self.keys[spots], self.ranks[spots] = keys[placed], ranks[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slots[left] = np.where(self.keys[slots[left]] == -1, slots[left], (slots[left] + 1) & self.mask)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.symbols + right
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            out[open_] = np.where(found == keys[open_], self.ranks[slots[open_]], NONE)
            open_ = open_[(found != keys[open_]) & (found != -1)]
        return out


class PieceCounter:
    """Counts tokens as the model's library does, without begin or end marks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        ids = [i for i in range(size)
               if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
        runs = {p for p in scores if len(p) > 1 and not p.strip(SPACE)}
        words = sorted((p for p in scores if p not in runs), key=lambda p: -scores[p])
        if any(SPACE in p[1:] for p in words):
            raise ValueError("a piece with a space after another character needs merges across words")
        self.runs = {len(p) for p in runs}
        chars = sorted({c for p in words for c in p} | {SPACE})
        self.char_id = {c: i for i, c in enumerate(chars)}
        longer = [p for p in words if len(p) > 1]
        symbol = self.char_id | {p: len(chars) + k for k, p in enumerate(longer)}
        # A character that is no piece itself counts its bytes if it stays single; so does one never seen.
        self.unknown = len(symbol)
        self.weight = np.ones(len(symbol) + 1, np.int64)
        for c in chars:
            if c not in scores:
                self.weight[symbol[c]] = len(c.encode())
        self.first_merged = len(chars)
        pairs = {}
        for k, p in enumerate(longer):
            for cut in range(1, len(p)):
                if p[:cut] in symbol and p[cut:] in symbol:
                    pairs[symbol[p[:cut]], symbol[p[cut:]]] = k
        self.pairs = PairTable(pairs, len(symbol) + 1)
        self.pair_rank = pairs
        codes = np.array([ord(c) for c in chars], np.int64)
        self.by_code = np.full(0x110000, self.unknown, np.int32)
        self.by_code[codes] = np.arange(len(chars), dtype=np.int32)
        self.space = self.char_id[SPACE]
        self.memo: dict[str, int] = {}

    # -- merging -----------------------------------------------------------
    def merge(self, words: list[str]) -> list[int]:
        """For each word: its tokens with a space before it, plus ALONE if that space stays single."""
        out = np.zeros(len(words), np.int64)
        text = SPACE + SPACE.join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        symbols = self.by_code[codes]
        extra = symbols == self.unknown
        if extra.any():
            at = np.flatnonzero(extra)
            owner = np.searchsorted(np.cumsum(lengths), at, side="right")
            wide = codes[at]
            np.add.at(out, owner, 0 + (wide >= 0x80) + (wide >= 0x800) + (wide >= 0x10000))
        which = np.arange(len(words))
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        ranks = np.full(len(symbols), NONE, np.int32)
        ranks[:-1] = self.pairs.rank(symbols[:-1], symbols[1:])
        ranks[starts[1:] - 1] = NONE
        while len(which):
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NONE
            if done.any():
                ends = np.concatenate((starts[1:], [len(symbols)]))
                self._finish(out, which[done], symbols, starts[done], ends[done])
                stay = np.repeat(~done, lengths)
                symbols, ranks, lengths, which, lowest = symbols[stay], ranks[stay], lengths[~done], which[~done], lowest[~done]
                if not len(which):
                    break
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            picked = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            near = np.diff(picked) == 1
            if near.any():  # of pairs that overlap, every second one, from the left
                run = np.concatenate(([0], np.flatnonzero(~near) + 1))
                place = np.arange(len(picked)) - np.repeat(run, np.diff(np.concatenate((run, [len(picked)]))))
                picked = picked[place % 2 == 0]
            merged_rank = ranks[picked]
            symbols[picked] = self.first_merged + merged_rank
            keep = np.ones(len(symbols), bool)
            keep[picked + 1] = False
            owner = np.searchsorted(starts, picked, side="right") - 1
            # The pair of a merged symbol with its right neighbour takes the place of the removed symbol's pair.
            ranks[picked] = ranks[picked + 1]
            symbols, ranks = symbols[keep], ranks[keep]
            lengths = lengths - np.bincount(owner, minlength=len(lengths))
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            now = picked - np.arange(len(picked))
            last = starts + lengths - 1
            right = now[now != last[owner]]
            left = now[now != starts[owner]] - 1
            fresh = np.concatenate((left, right))
            ranks[fresh] = self.pairs.rank(symbols[fresh], symbols[fresh + 1])
            ranks[last] = NONE
            of = np.concatenate((owner[now != starts[owner]], owner[now != last[owner]]))
            early = ranks[fresh] < lowest[of]
            if early.any():  # a merge made a pair of lower rank: that word is merged pair by pair
                odd = np.unique(of[early])
                for k in which[odd]:
                    out[k] = self._one(words[k])
                gone = np.zeros(len(which), bool)
                gone[odd] = True
                stay = np.repeat(~gone, lengths)
                symbols, ranks, lengths, which = symbols[stay], ranks[stay], lengths[~gone], which[~gone]
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        return out.tolist()

    def _finish(self, out, which, symbols, starts, ends):
        sums = np.concatenate(([0], np.cumsum(self.weight[symbols])))
        out[which] += sums[ends] - sums[starts] + np.where(symbols[starts] == self.space, ALONE, 0)

    def _one(self, word: str) -> int:
        row = [self.char_id.get(c, self.unknown) for c in SPACE + word]
        size = sum(len(c.encode()) - 1 for c in word if c not in self.char_id)
        while True:
            best = min(((self.pair_rank.get(p, NONE), i) for i, p in enumerate(zip(row, row[1:]))), default=(NONE, 0))
            if best[0] == NONE:
                break
            row[best[1]:best[1] + 2] = [self.first_merged + best[0]]
        return size + sum(int(self.weight[s]) for s in row) + (ALONE if row[0] == self.space else 0)

    def run_tokens(self, spaces: int) -> int:
        """Tokens of a run of spaces: the leftmost pair that has a piece merges first."""
        done, left, here = [], spaces, 0
        while left or here:
            if not here:
                here, left = 1, left - 1
            elif done and done[-1] + here in self.runs:
                here += done.pop()
            elif left and here + 1 in self.runs:
                here, left = here + 1, left - 1
            else:
                done.append(here)
                here = 0
        return len(done)

    # -- texts -------------------------------------------------------------
    def count(self, texts: list[str]) -> list[int]:
        split = [t.replace(SPACE, " ").split(" ") if t else [] for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo, once = self.memo, {}
        missing = set().union(*split).difference(memo)
        missing.discard("")
        short = [w for w in missing if len(w) <= MEMO_LENGTH]
        for at in range(0, len(short), BLOCK_WORDS):
            block = short[at:at + BLOCK_WORDS]
            memo.update(zip(block, self.merge(block)))
        for word in [w for w in missing if len(w) > MEMO_LENGTH]:
            once[word] = self.merge([word])[0]
        return [self._total(words, memo, once) for words in split]

    def _total(self, words, memo, once) -> int:
        if "" not in words and not once:
            return sum(map(memo.__getitem__, words)) % ALONE
        total, waiting = 0, 0
        for w in words:
            if not w:
                waiting += 1
                continue
            count = memo[w] if w in memo else once[w]
            alone, count = divmod(count, ALONE)
            total += count
            if waiting:
                total += self.run_tokens(waiting + 1) - 1 if alone else self.run_tokens(waiting)
                waiting = 0
        return total + (self.run_tokens(waiting) if waiting else 0)


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(df: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every whole text.

    ``model_path`` is the vocabulary file, at the same place on every machine.
    """
    def work(texts: list[str]) -> list[list]:
        return [[len(t.encode()) for t in texts], counter(model_path).count(texts)]

    return (map_texts(df, work, [("n_bytes", "long"), ("n_tokens", "long")], id_col, text_col)
            .withColumn("over_limit", F.col("n_tokens") > limit))
