"""Row-wise text operators against their libraries or brute force."""

import hashlib
import functools
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallywell.llm import byte_bpe, license_scan, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BITS = ["a", "b", "th", "e", " ", "  ", "   ", "\n", "\r", "é", "ñ", "中", "文", "😀", "▁", "0", "1", "ing", "tion", "<s>", "\t",
        "=", "==", "*", "\x00", "ſ", "<|endoftext|>", "'s", "'ll", "²", "ⅷ", "\x1c", "\x85", "\xa0", "　", "İ", "ʰ"]


def odd_texts(n=3000, seed=1):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    texts += ["".join(rnd.choice("abehinorst") for _ in range(rnd.randint(10, 300))) for _ in range(300)]
    texts += [" " * k + "x" * (k % 3) for k in range(0, 60)]
    return texts + ["x" * 3000, "ab" * 2000, " " * 3000, "=" * 777, "the" * 900, "aaaaab" * 400, ""]


def test_token_counts_equal_the_library():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts()
    assert token_counts.counter(PIECES).count(texts) == [len(x) for x in model.encode(texts)]


def test_token_counts_do_not_depend_on_the_memo(monkeypatch):
    counter = token_counts.PieceCounter(PIECES)
    texts = odd_texts(300)
    first = counter.count(texts)
    monkeypatch.setattr(token_counts, "MEMO_WORDS", 5)
    monkeypatch.setattr(token_counts, "MEMO_LENGTH", 3)
    monkeypatch.setattr(token_counts, "BLOCK_WORDS", 7)
    assert token_counts.PieceCounter(PIECES).count(texts) == first == counter.count(texts)


def test_pair_by_pair_merge_agrees_with_rounds():
    counter = token_counts.counter(PIECES)
    words = [w for t in odd_texts(200) for w in t.replace("▁", " ").split(" ") if w and len(w) < 80]
    assert counter.merge(words) == [counter._one(w) for w in words]


def test_byte_bpe_equals_the_library_and_round_trips():
    import tiktoken
    codec = byte_bpe.codec(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    texts = odd_texts()
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text))
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_tree_does_not_depend_on_where_it_is_cut(monkeypatch, leaf):
    codec = byte_bpe.codec(RANKS)
    words = [w for t in odd_texts(300) for w in codec.matches(t)]
    monkeypatch.setattr(byte_bpe, "LEAF", leaf)
    assert all(codec.tree(w.encode()) == codec.merge(w.encode()) for w in words if len(w) < 200)


def test_both_pattern_engines_split_alike():
    codec = byte_bpe.codec(RANKS)
    low = "".join(map(chr, range(0x250)))
    rnd = random.Random(2)
    for _ in range(2000):
        text = "".join(rnd.choice(low) for _ in range(30))
        assert codec.split_low(text) == codec.split_any(text)


def base_places(text):
    words = license_scan.words_of(text)
    return [(i, label) for phrase, label in license_scan.PHRASES.items()
            for own in [license_scan.words_of(phrase)]
            for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]


def test_license_phrases_equal_brute_force():
    scanner = license_scan.LicenseScanner(license_scan.PHRASES, license_scan.TEMPLATES)
    rnd = random.Random(3)
    bits = "under the mit license apache license version 2 0 cc by nc of software cc by permission is hereby granted".split()
    for _ in range(3000):
        text = " ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 80)))
        found = scanner.scan(text)
        assert found.words == len(license_scan.words_of(text))
        assert sorted(found.phrases) == sorted(base_places(text))


def plain_cover(matches, size):
    """Most words of a template that matches in order can cover, by trying all chains."""
    @functools.lru_cache(None)
    def after(k):
        start, place, n = matches[k]
        return max([n] + [n + after(j) - max(0, start + n - s, place + n - p) for j, (s, p, m) in enumerate(matches)
                          if s > start and p > place and 0 <= max(0, start + n - s, place + n - p) < m and s - start - n <= license_scan.MAX_GAP
                          and p + m > place + n and s + m > start + n])

    return max(map(after, range(len(matches))), default=0) / size


def test_license_chains_equal_all_chains():
    scanner = license_scan.LicenseScanner({}, {"t": " ".join(f"w{k}" for k in range(60))})
    rnd = random.Random(7)
    for _ in range(300):
        own = sorted({(rnd.randint(0, 90), rnd.randint(0, 40), rnd.randint(5, 20)) for _ in range(rnd.randint(1, 8))})
        best = plain_cover(tuple(own), 60)
        spans = scanner._heaviest(0, own)
        assert bool(spans) == (best >= license_scan.MIN_COVER)
        assert not spans or max(s.cover for s in spans) == pytest.approx(min(1.0, best))
        ends = sorted((s.start, s.end) for s in spans)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_a_second_place_does_not_close_a_chain():
    scanner = license_scan.LicenseScanner(license_scan.PHRASES, license_scan.TEMPLATES)
    bsd = license_scan.TEMPLATES["bsd"].replace("Redistributions of source", "1. Redistributions of source").replace(
        "Redistributions in binary", "2. Redistributions in binary").replace("must retain", "should keep")
    assert [s.label for s in scanner.scan("intro " + bsd + " outro").spans] == ["bsd"]
    assert [s.label for s in scanner.scan(bsd + " and again " + bsd).spans] == ["bsd", "bsd"]


def test_license_templates_are_chained_over_changes():
    scanner = license_scan.LicenseScanner(license_scan.PHRASES, license_scan.TEMPLATES)
    for label, template in license_scan.TEMPLATES.items():
        words = template.split()
        words[len(words) // 2] = "elsewhere"
        spans = scanner.scan("before it " + " ".join(words) + " behind it").spans
        assert [s.label for s in spans] == [label] and 0.5 <= spans[0].cover < 1 and spans[0].start <= 3
    assert scanner.scan("the software and the use of the files " * 50).spans == []


def test_matching_statistics_equal_brute_force():
    auto = license_scan.SuffixAutomaton()
    rows = [[1, 2, 1, 2, 3], [2, 3, 1, 1], [3, 3, 2]]
    for k, row in enumerate(rows):
        auto.add(k, row)
    auto.close()
    rnd = random.Random(5)
    for _ in range(500):
        text = [rnd.randint(1, 3) for _ in range(12)]
        state = size = 0
        for i, token in enumerate(text):
            while state and token not in auto.next[state]:
                state = auto.link[state]
                size = auto.length[state]
            if token in auto.next[state]:
                state, size = auto.next[state][token], size + 1
            held = [n for n in range(i + 2) if any(text[i + 1 - n:i + 1] == row[a:a + n] for row in rows for a in range(len(row) - n + 1))]
            assert size == max(held)
            places = {(k, a + size - 1) for k, row in enumerate(rows) for a in range(len(row) - size + 1) if row[a:a + size] == text[i + 1 - size:i + 1]}
            assert size == 0 or set(auto.ends[state]) == places


def test_text_operators_on_a_table(spark):
    rows = [(1, "The MIT thing, under the MIT license."), (None, "a  b"), (3, None), (4, ""), (1, "The MIT thing, under the MIT license.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n_tokens": F.lit("x"), "labels": F.lit(1), "own``name": F.lit(2)})
    counts = {r.doc_id: r for r in token_counts.count_tokens(df, PIECES, limit=2).collect()}
    assert (counts[None].n_tokens, counts[3].n_tokens, counts[4].n_bytes, counts[None].over_limit) == (3, 0, 0, True)
    assert token_counts.count_tokens(df, PIECES).count() == 5
    coded = {r.doc_id: r for r in byte_bpe.round_trip(df, RANKS).collect()}
    assert coded[None].decoded_sha256 == hashlib.sha256(b"a  b").hexdigest() and coded[3].n_tokens == 0
    assert coded[4].ids_sha256 == hashlib.sha256(b"").hexdigest()
    found = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    assert (found[1].first_word, found[1].base_labels, found[1].score) == (3, "mit", 1.0)
    assert (found[3].n_words, found[3].first_word, found[3].labels, found[3].score) == (0, None, "", 0.0)
    empty = df.limit(0)
    for made in (token_counts.count_tokens(empty, PIECES), byte_bpe.encode_texts(empty, RANKS), license_scan.scan_licenses(empty)):
        assert made.count() == 0
