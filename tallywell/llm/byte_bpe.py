"""Byte-level BPE as a monoid: encode halves, join neighbours, concatenate.

A row of tokens is what BPE gives for its bytes exactly if every two
neighbouring tokens are *stable*, that is if BPE leaves the two of them as they
are when it meets only their bytes. So two encoded halves are joined by
encoding a window around their border anew and widening it, on the side that
still moves, until the tokens next to it are stable with its ends. Tokens
outside the window then cannot change, and the cost of a join does not depend
on the length of the halves.

The pattern's matches are encoded separately, so joining across them is plain
concatenation; decoding folds the tokens' bytes up the same kind of tree.

Cases: a null or empty text has no token; special strings are ordinary text;
repeated rows are encoded each; a text or match of any length is cut in halves.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from tallywell.llm.rows import map_texts

#: Bytes that are merged directly, as a leaf of the tree.
LEAF = 16
#: Above every rank.
NEVER = 1 << 40
#: Matches and pairs that a Python worker remembers, and the longest match.
MEMO_MATCHES, MEMO_PAIRS, MEMO_LENGTH = 200_000, 300_000, 48
#: Tokens decoded in one leaf.
DECODE_LEAF = 4096

# Letters, digits and white space among the code points up to U+024F.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
SPACES = "\t-\r \x85\xa0"
KNOWN_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def fold(parts: Sequence, join: Callable):
    """Reduce neighbours pairwise, level by level."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


class TreeCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.single = [bytes([b]) for b in range(256)]
        self.token = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.token[i] = b
        self.split_any = regex.compile(pattern).findall
        self.split_low = None
        if pattern == KNOWN_PATTERN:
            # The same pattern for texts without a higher code point, in the faster engine.
            s, n, l = SPACES, NUMBERS, LETTERS
            self.split_low = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{l}]+| ?[{n}]+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+").findall
        self.higher = re.compile("[^\x00-ɏ]").search
        self.packed: dict[str, bytes] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def matches(self, text: str) -> list[str]:
        if self.split_low and not self.higher(text):
            return self.split_low(text)
        return self.split_any(text)

    # -- one match ---------------------------------------------------------
    def merge(self, data: bytes) -> tuple[bytes, ...]:
        """Plain BPE of a few bytes: the pair of lowest rank, leftmost first."""
        get, token, single = self.ranks.get, self.token, self.single
        parts = [single[b] for b in data]
        ranks = [get(data[i:i + 2], NEVER) for i in range(len(data) - 1)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [token[best]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], NEVER)
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], NEVER)
        return tuple(parts)

    def stable(self, a: bytes, b: bytes) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(a + b) == (a, b)
        return known

    def join(self, left: tuple[bytes, ...], right: tuple[bytes, ...]) -> tuple[bytes, ...]:
        if self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join(left[-i:]) + b"".join(right[:j]))
            moves_left = i < len(left) and not self.stable(left[-i - 1], window[0])
            moves_right = j < len(right) and not self.stable(window[-1], right[j])
            if not (moves_left or moves_right):
                return left[:-i] + window + right[j:]
            i, j = i + moves_left, j + moves_right

    def tree(self, data: bytes) -> tuple[bytes, ...]:
        return fold([self.merge(data[i:i + LEAF]) for i in range(0, len(data), LEAF)], self.join)

    def pack(self, match: str) -> bytes:
        data = match.encode()
        whole = self.ranks.get(data)
        row = [whole] if whole is not None else [self.ranks[t] for t in self.tree(data)]
        return struct.pack(f"<{len(row)}I", *row)

    # -- texts -------------------------------------------------------------
    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.matches(t) for t in texts]
        if len(self.packed) > MEMO_MATCHES:
            self.packed.clear()
        packed, once = self.packed, {}
        for m in set().union(*split).difference(packed):
            (packed if len(m) <= MEMO_LENGTH else once)[m] = self.pack(m)
        if not once:
            return [b"".join(map(packed.__getitem__, row)) for row in split]
        return [b"".join(packed[m] if m in packed else once[m] for m in row) for row in split]

    def decode(self, ids: bytes) -> bytes:
        row, token = np.frombuffer(ids, "<u4").tolist(), self.token
        leaves = [b"".join([token[i] for i in row[at:at + DECODE_LEAF]]) for at in range(0, len(row), DECODE_LEAF)]
        return fold(leaves or [b""], bytes.__add__)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def codec(path: str, pattern: str = KNOWN_PATTERN) -> TreeCodec:
    return TreeCodec(read_ranks(path), pattern)


def encode_texts(df: DataFrame, ranks_path: str, pattern: str = KNOWN_PATTERN, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids``: the ids packed as little-endian unsigned 32-bit integers."""
    def work(texts):
        rows = codec(ranks_path, pattern).encode(texts)
        return [[len(r) // 4 for r in rows], rows]

    return map_texts(df, work, [("n_tokens", "long"), ("ids", "binary")], id_col, text_col)


def round_trip(df: DataFrame, ranks_path: str, pattern: str = KNOWN_PATTERN, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode whole texts, decode the ids: ``id, n_tokens, ids_sha256, decoded_sha256``."""
    def work(texts):
        own = codec(ranks_path, pattern)
        rows = own.encode(texts)
        return [[len(r) // 4 for r in rows], [hashlib.sha256(r).hexdigest() for r in rows],
                [hashlib.sha256(own.decode(r)).hexdigest() for r in rows]]

    return map_texts(df, work, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
                     id_col, text_col)


def encode_and_check(df: DataFrame, ranks_path: str, pattern: str = KNOWN_PATTERN, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Encode whole texts, decode the ids: ``id, n_tokens, ids, ids_sha256, decoded_sha256``."""
    def work(texts):
        own = codec(ranks_path, pattern)
        rows = own.encode(texts)
        return [[len(r) // 4 for r in rows], rows, [hashlib.sha256(r).hexdigest() for r in rows],
                [hashlib.sha256(own.decode(r)).hexdigest() for r in rows]]

    return map_texts(df, work, [("n_tokens", "long"), ("ids", "binary"), ("ids_sha256", "string"),
                                ("decoded_sha256", "string")], id_col, text_col)
