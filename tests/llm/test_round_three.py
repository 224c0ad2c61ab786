"""Centroid clusters, language model scores and phrases against brute force."""

import collections
import hashlib
import math
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywell.llm import centroid_clusters, maxent_lm, phrases


# -- centroid clusters -----------------------------------------------------
def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    at = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        held = collections.defaultdict(list)
        for _, v in kept:
            held[nearest(v)[1]].append(v)
        at = [[sum(x) // len(held[j]) for x in zip(*held[j])] if j in held else c for j, c in enumerate(at)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, j in found:
        inertia[j] += d
    return sorted(((i is None, i or 0), j, d, inertia[j], sum(inertia.values()),
                   hashlib.sha256(",".join(map(str, at[j])).encode()).hexdigest()) for i, d, j in found)


@pytest.mark.parametrize("k,count", [(5, 120), (40, 17), (1, 20), (3, 0)])
def test_clusters_equal_brute_force(spark, k, count):
    rnd = np.random.default_rng(k)
    rows = [(i, [float(x) for x in rnd.normal(0, 2, 6).round(2)]) for i in range(count)]
    if count:
        rows += [(3, rows[3][1]), (3, rows[4][1]), (7, rows[7][1]), (None, [0.5] * 6), (900, None), (901, [1.0] * 5), (902, []),
                 (903, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (904, [float("nan")] * 6), (905, [float("inf")] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash"))
    got = centroid_clusters.cluster_vectors(df.repartition(4), k, 5, 2, dims=6)
    assert sorted(((r.id is None, r.id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got.collect()) \
        == plain_clusters(rows, k, 5, 6)


def test_ties_copies_and_huge_components(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(12)] + [(50, [1e30, -1e30]), (51, [1e12, 1e12])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: r for r in centroid_clusters.cluster_vectors(df, 4, 3, 2, dims=2).collect()}
    assert len(got) == 14 and all(0 <= r.distance <= centroid_clusters.LONG for r in got.values())
    for parity in (0, 1):
        assert len({got[i].cluster for i in range(12) if i % 2 == parity}) == 1


def test_the_search_is_exact_and_measures_less(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.integers(-3000, 3000, (30, 8))
    rows = (centres[rnd.integers(0, 30, 5000)] + rnd.integers(-40, 40, (5000, 8))).astype(float)
    search = centroid_clusters.Orchard(centres.tolist())
    best, least, measured = search.search(rows)
    apart = ((rows[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()
    assert measured < 5000 * 30 / 4
    twins = centroid_clusters.Orchard([[5, 5], [1, 1], [1, 1], [1, 3]])
    whole = [min(range(4), key=lambda j: ((x - [5, 1, 1, 1][j]) ** 2 + (y - [5, 1, 1, 3][j]) ** 2, j)) for x, y in ((1, 2), (1, 1), (3, 3))]
    assert twins.search(np.array([[1.0, 2.0], [1.0, 1.0], [3.0, 3.0]]))[0].tolist() == whole


# -- phrases ---------------------------------------------------------------
def plain_phrases(docs, least, top=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, held in counts.items():
        fine = {p: a for p, a in held.items() if len(p) > 1 and a >= least}
        told = []
        for p, a in fine.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in fine.items()):
                continue
            score, _, left, right = min((2000000 * a // (held[p[:k]] + held[p[k:]]), k, held[p[:k]], held[p[k:]]) for k in range(1, len(p)))
            told.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, totals[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(told)[:top], 1)]
    return sorted(out)


def mined(df, **how):
    return sorted(tuple(r) for r in phrases.mine_phrases(df, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrase_docs():
    rnd = random.Random(5)
    words = ["New", "york", "times", "the", "of", "état", "Éa", "x y", "\U0001f600", "a", "b"]
    docs = [(rnd.choice(["en", "de", None, ""]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "\t", " , ", ".", "\n", "  "]) for _ in range(rnd.randint(0, 90))))
            for _ in range(300)]
    return docs + [("en", None), (None, None), ("en", "..,,!!\n\n"), ("en", "no no no no no no " * 400), ("fr", "once only")]


@pytest.mark.parametrize("least,top", [(30, 2000), (12, 5)])
def test_phrases_equal_brute_force(spark, least, top):
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("phrase", F.lit("clash")).withColumn("n", F.lit(1))
    assert mined(df.repartition(6), least=least, top=top) == plain_phrases(docs, least, top)
    assert mined(df.limit(0)) == []


def test_packed_counts_hold_every_run():
    hashes = np.random.default_rng(4).integers(0, 2**63, 500, dtype=np.uint64) % np.uint64(2**40)
    packed = phrases.packed_counts([np.concatenate((hashes, hashes[:50]))], 7)
    got = collections.Counter()
    for r in packed.to_pylist():
        once, more, times = (np.frombuffer(r[c], np.uint32).tolist() for c in ("once", "more", "times"))
        for key, n in [*((k, 1) for k in once), *zip(more, times)]:
            got[r["part"], key] += n
        assert r["mass"] == len(once) + sum(times)
    want = collections.Counter(((h & 0xFFFFFFFF) % 7, h >> 32) for h in [*hashes.tolist(), *hashes[:50].tolist()])
    assert got == want


def test_a_summary_keeps_every_frequent_key():
    rnd = np.random.default_rng(1)
    for least in (5, 30):
        keys = np.concatenate((rnd.zipf(1.3, 30_000) % 100_000, np.repeat(np.arange(200_000, 200_040), least)))
        rnd.shuffle(keys)
        halves = [phrases.Summary(len(keys) // least + 1) for _ in range(2)]
        for at in range(0, len(keys), 700):
            k, n = np.unique(keys[at:at + 700], return_counts=True)
            halves[at // 700 % 2].add(k, n)
        for half in halves:
            half.merge()
        halves[0].add(halves[1].keys, halves[1].counts)
        halves[0].merge()
        whole = collections.Counter(keys.tolist())
        assert set(halves[0].keys.tolist()) >= {k for k, n in whole.items() if n >= least}
        assert halves[0].taken + halves[1].taken < least
        small = phrases.Summary(10)
        small.add(*np.unique(keys, return_counts=True))
        small.merge()
        assert len(small.keys) <= 10


# -- language model --------------------------------------------------------
def lm_docs():
    rnd = random.Random(9)
    kinds = [[f"{s}{i}" for i in range(40)] for s in ("Al", "be", "ça")]
    docs = []
    for d in range(400):
        words = rnd.choice(kinds)
        docs.append((d, " ".join(words[min(39, int(rnd.expovariate(0.15)))] for _ in range(rnd.randint(0, 60))) + rnd.choice(["", "\n\tx", f" once{d}"])))
    return docs + [(400, None), (401, ""), (None, "al1 al2"), (5, "be1 unseen"), (5, "be1 unseen"), (402, " ".join(["long"] * 9000))]


def test_counts_and_base_scores_equal_brute_force(spark):
    docs = lm_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("row", F.lit(1))
    model = maxent_lm.fit(df.repartition(4))
    got = maxent_lm.score_texts(df.repartition(3), model).collect()
    left = {d: None if d is None else zlib.crc32(str(d).encode()) % 5 for d, _ in docs}
    count = collections.Counter()
    for d, text in docs:
        if left[d] not in (None, 1):
            count.update([*(text or "").encode().lower().split(), None])
    n, v = sum(count.values()), len(count)
    want = []
    for d, text in docs:
        tokens = [*(text or "").encode().lower().split(), None]
        want.append(((d is None, d or 0), left[d] == 1, len(tokens), sum(count[t] > 0 for t in tokens), n,
                     sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)))
    have = [((r.id is None, r.id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got]
    for a, b in zip(sorted(have), sorted(want)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert len(have) == len(want)
    held = [r for r in got if r.held_out and r.id != 402]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_all_tokens_sum_to_one(spark):
    docs = lm_docs()
    model = maxent_lm.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    vocab, weights = model.vocab.value, model.weights.value
    first, ids = "be1 be2 al3", vocab.ids("be1 be2 al3")[0]
    at = np.array([len(ids) - 1])
    rows = maxent_lm.feature_rows(ids, vocab.classes, at)
    share = np.array([np.exp(weights.log_share(rows, np.array([c])))[0] for c in range(maxent_lm.CLASSES)])
    assert share.sum() == pytest.approx(1, abs=1e-5)
    count = collections.Counter()
    for d, text in docs:
        if d is not None and zlib.crc32(str(d).encode()) % 5 != 1:
            count.update((text or "").encode().lower().split())
    inside = collections.Counter()
    for w, c in count.items():
        inside[int(vocab.classes[vocab.place[w]])] += c + 0.5
    for c in range(maxent_lm.SINGLE + maxent_lm.GROUPED):
        assert inside[c] == pytest.approx(vocab.mass[c]) or inside[c] == 0
    # All these words are in the lexicon, so the classes by ending hold their unknown token only.
    assert vocab.mass[maxent_lm.SINGLE + maxent_lm.GROUPED:-1] == pytest.approx(0.5)
    # The query's score is the product of these factors, token by token.
    (row,) = maxent_lm.score_texts(spark.createDataFrame([(1, first)], "doc_id long, text string"), model).collect()
    whole = 0.0
    for i in range(maxent_lm.BACK, len(ids)):
        c = int(vocab.classes[ids[i]])
        own = np.exp(weights.log_share(maxent_lm.feature_rows(ids, vocab.classes, np.array([i])), np.array([c])))[0]
        whole += math.log10(own * 10 ** vocab.log_count[ids[i]] / vocab.mass[c])
    assert row.score == pytest.approx(whole, rel=1e-5)


def test_a_gradient_step_follows_the_likelihood():
    rnd = np.random.default_rng(2)
    weights = maxent_lm.Weights()
    rows, target = rnd.integers(0, 40, (3, 64)), rnd.integers(0, maxent_lm.CLASSES, 64)
    before = weights.log_share(rows, target).sum()
    for _ in range(20):
        weights.learn(rows, target)
    assert weights.log_share(rows, target).sum() > before + 20


def test_words_beyond_the_bounded_tables_are_joined(spark):
    held = [(w, c) for w, c in (("a", 5), ("b", 4))]
    vocab = maxent_lm.Vocabulary([w.encode() for w, _ in held], np.array([c for _, c in held]), 2, 20, 5, 3)
    maxent_lm.with_classes(vocab, np.ones((2, maxent_lm.DIRECTIONS)), np.zeros(maxent_lm.ENDINGS))
    sc = spark.sparkContext
    counts = spark.createDataFrame([(b"c", 7, 7), (b"d", 0, 2), (b"a", 5, 5), (None, 3, 3)], "word binary, c long, t long")
    model = maxent_lm.Model(sc.broadcast(vocab), sc.broadcast(maxent_lm.Weights()), counts)
    (row,) = maxent_lm.score_texts(spark.createDataFrame([(1, "a C c d e")], "doc_id long, text string"), model).collect()
    part = sum(math.log10(c + 0.5) for c in (5, 7, 7, 0, 0, 3)) - 6 * math.log10(20 + 0.5 * 6)
    assert (row.n_tokens, row.n_known) == (6, 4) and row.base_score == pytest.approx(part)


def test_no_training_text(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = maxent_lm.score_texts(df, maxent_lm.fit(df)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert maxent_lm.score_texts(df.limit(0), maxent_lm.fit(df.limit(0))).count() == 0


def odd_texts(n=600):
    rnd = random.Random(3)
    signs = [chr(i) for i in range(300)] + ["\u3000", "\u2028", "😀", "É", "İ"] + list(" \t\n\x0b\x0c\r") * 12
    return ["", " ", "\n\r", "a", " a", "a "] + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 50))) for _ in range(n)]


def test_texts_are_cut_and_looked_up_as_python_would():
    texts = odd_texts()
    plain = [t.encode().lower().split() for t in texts]
    flat = [w for p in plain for w in p]
    for column in (pa.array(texts), pa.array(["x y", *texts]).slice(1)):
        words, many = maxent_lm.cut(column)
        assert words.to_pylist() == flat and many.tolist() == list(map(len, plain))
        assert maxent_lm.endings(words.slice(3)).tolist() == [zlib.crc32(w[-2:]) % maxent_lm.ENDINGS for w in flat[3:]]
    held = sorted(set(flat))[::2]
    vocab = maxent_lm.Vocabulary(held, np.ones(len(held), np.int64), len(held), 1, 1, 1)
    got = vocab.entries(pa.array(texts))
    place = {w: i for i, w in enumerate(held)}
    want = [[*[vocab.start] * maxent_lm.BACK, *[place.get(w, vocab.first_ending + maxent_lm.ending(w)) for w in p], vocab.end] for p in plain]
    assert got.ids.tolist() == [i for w in want for i in w]
    assert got.sizes.tolist() == [len(p) + 1 for p in plain]
    at = np.concatenate(list(got.steps()))
    assert at.tolist() == np.flatnonzero(got.ids != vocab.start).tolist()
    words, times = (c.to_pylist() for c in got.rare_counts())
    assert [dict(zip(w, n)) for w, n in zip(words, times)] == [collections.Counter(w for w in p if w not in place) for p in plain]


@pytest.mark.parametrize("held,chunk", [(400_000, 8 << 20), (50, 1), (1, 1)])
def test_words_of_a_task_are_counted_in_any_number_of_parts(monkeypatch, held, chunk):
    monkeypatch.setattr(maxent_lm, "HELD_WORDS", held)
    monkeypatch.setattr(maxent_lm, "CHUNK", chunk)
    texts = odd_texts(900)
    learn = [i % 3 > 0 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(learn), pa.array(texts)], names=["learn", "text"])
    got = {True: collections.Counter(), False: collections.Counter()}
    for part in maxent_lm.counted(iter([batch.slice(0, 300), batch.slice(300), batch.slice(0, 0)])):
        for r in part.to_pylist():
            assert r["ending"] == (-1 if r["word"] is None else maxent_lm.ending(r["word"]))
            got[True][r["word"]] += r["c"]
            got[False][r["word"]] += r["t"]
    for only in (True, False):
        want = collections.Counter(w for t, on in zip(texts, learn) if on or not only for w in [*t.encode().lower().split(), None])
        assert +got[only] == want
    assert not list(maxent_lm.counted(iter([])))


def test_work_on_words_is_in_arrays():
    """No call of Python for each word, which was most of the query's time."""
    vocab = maxent_lm.Vocabulary([b"a", b"b"], np.ones(2, np.int64), 2, 4, 2, 1)

    def calls(words):
        seen = []
        texts = pa.array([" ".join(["a", "B", f"rare{k}"][k % 3] for k in range(words))] * 2)
        sys.setprofile(lambda frame, event, arg: seen.append(event) if event.endswith("call") else None)
        vocab.entries(texts).rare_counts()
        list(maxent_lm.counted(iter([pa.RecordBatch.from_arrays([pa.array([True, False]), texts], names=["learn", "text"])])))
        sys.setprofile(None)
        return len(seen)

    calls(9)
    assert calls(3000) == calls(30)


@pytest.mark.parametrize("places", [40, 3000])
def test_a_step_sums_gaps_by_row_without_sorting(monkeypatch, places):
    rnd = np.random.default_rng(5)
    rows = rnd.integers(0, 5000, places * 3)
    gap, weights, slopes = rnd.normal(size=(places, 4)).astype(np.float32), np.ones((5000, 4), np.float32), np.zeros(5000, np.float32)
    monkeypatch.setattr(np, "unique", None)
    maxent_lm._step(weights, slopes, rows, gap, 0.1)
    slope = np.zeros((5000, 4))
    np.add.at(slope, rows, np.tile(gap, (3, 1)))
    squares = (slope ** 2).sum(axis=1) / 4
    assert slopes == pytest.approx(squares, rel=1e-5)
    assert weights == pytest.approx(1 - 0.1 * slope / np.sqrt(squares + 1e-6)[:, None], abs=1e-5)
