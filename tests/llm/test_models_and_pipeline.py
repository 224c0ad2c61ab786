"""Quality rules, toxicity, near-duplicates and the pipeline on planted and brute-force cases."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywell.llm import components, line_dedup, near_dedup, quality_rules, toxicity
from test_tables import plain_dedup

WORDS = ["".join(p) for p in zip("bcdfghklmnprst" * 30, "aeiou" * 84, "lmnrstx" * 60, "aeiou" * 84)]


def prose(rnd, n):
    words = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)]
    return ". ".join(" ".join(words[k:k + 8]).capitalize() for k in range(0, n, 8)) + "."


def junk(rnd, n):
    return rnd.choice([" ".join(w + "%%%" for w in prose(rnd, n).split()), " | ".join([rnd.choice(WORDS)] * n), prose(rnd, n).upper().replace(" ", "!! ")])


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# -- quality ---------------------------------------------------------------
def test_quality_on_held_out_rows(spark):
    rnd = random.Random(1)
    docs = [(i, prose(rnd, rnd.randint(10, 120)) if i % 3 else junk(rnd, rnd.randint(10, 120))) for i in range(600)]
    labels = [(i, 1 if i % 3 else 0) for i in range(600)]
    # Labels of held-out rows are wrong on purpose: a fit that read them would fail.
    labels = [(i, 1 - y if held(i) else y) for i, y in labels]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("clash"), "words": F.lit(1), "label": F.lit(0)})
    model = quality_rules.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    scored = quality_rules.score_quality(df, model, score_col="quality").collect()
    right = [(r.quality >= 0.3) == bool(r.doc_id % 3) for r in scored if held(r.doc_id)]
    assert sum(right) >= 0.97 * len(right) and 0 < len(model.rules) < 200
    assert all(0 <= r.quality <= 1 for r in scored)


def test_rules_are_paths_and_columns(spark):
    printed = "Model\n  If (feature 0 <= 2.0)\n   If (feature 1 <= 1.0)\n    Predict: 0.0\n   Else (feature 1 > 1.0)\n    Predict: 1.0\n  Else (feature 0 > 2.0)\n   Predict: 1.0\n"
    rules = quality_rules.tree_rules(printed, ["x", "y"])
    assert [dict((n, (a, b)) for n, a, b in r.bounds) for r in rules] == [
        {"x": (-np.inf, 2.0)}, {"x": (-np.inf, 2.0), "y": (-np.inf, 1.0)}, {"x": (-np.inf, 2.0), "y": (1.0, np.inf)}, {"x": (2.0, np.inf)}]
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 0.0)], "x double, y double")
    got = [tuple(r) for r in df.select(*[r.column() for r in rules]).collect()]
    assert got == [(True, True, False, False), (True, False, True, False), (False, False, False, True)]


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "some text"), (2, ""), (3, "x " * 20000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (2, 1), (2, None), (None, 0), (9, 0)], "doc_id long, quality int")
    for labels, low, high in ((none, 0.5, 0.5), (one, 0.5, 1.0)):
        scores = [r.score for r in quality_rules.score_quality(docs, quality_rules.fit(docs, labels)).collect()]
        assert len(scores) == 5 and all(low <= s <= high for s in scores)
    assert quality_rules.score_quality(docs.limit(0), quality_rules.fit(docs.limit(0), none)).count() == 0


# -- toxicity --------------------------------------------------------------
def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(2)
    bad = ["idiotish", "trashy", "moronic", "scummy"]

    def text(grade):
        words = prose(rnd, rnd.randint(20, 80)).split()
        for _ in range(2 * grade):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        return " ".join(words)

    rows = [(i, text(g), g) for i, g in ((i, rnd.choice([0, 0, 0, 1, 2])) for i in range(700))]
    df = spark.createDataFrame(rows, "doc_id long, text string, severity int").withColumn("toxic", F.lit("clash"))
    grades = spark.createDataFrame([(i, g) for i, _, g in rows if not held(i)], "doc_id long, grade int")
    model = toxicity.fit(df, grades, features=200)
    assert (np.diff(model.cuts) > 0).all() and len(model.cuts) == 2
    got = {r.doc_id: r for r in toxicity.score_severity(df, model).collect()}
    test = [(got[i], g) for i, _, g in rows if held(i)]
    assert np.mean([r.toxic == (g > 0) for r, g in test]) > 0.97
    means = [np.mean([r.severity for r, g in test if g == k]) for k in range(3)]
    assert means[0] < 0.3 < means[1] < means[2]
    binary = toxicity.fit(df, grades.withColumn("grade", (F.col("grade") > 0).cast("int")), features=200, split_top=3)
    assert len(binary.cuts) >= 2 and (np.diff(binary.cuts) > 0).all()


def test_ordinal_slope_equals_differences():
    rnd = np.random.default_rng(3)
    x = (np.repeat(np.arange(40), 2), rnd.integers(0, 3, 80), rnd.random(80))
    grade = rnd.integers(0, 3, 40)
    weights, cuts = toxicity.fit_ordinal(x, grade, 3, steps=2000)

    def loss(w, c):
        score = np.bincount(x[0], x[2] * w[x[1]], 40)
        p = np.concatenate((np.ones((40, 1)), 1 / (1 + np.exp(c - score[:, None])), np.zeros((40, 1))), axis=1)
        return -np.log(p[np.arange(40), grade] - p[np.arange(40), grade + 1]).mean() + toxicity.RIDGE / 2 * (w @ w)

    best = loss(weights, cuts)
    for k in range(5):
        for step in (-1e-2, 1e-2):
            w, c = weights.copy(), cuts.copy()
            (w if k < 3 else c)[k if k < 3 else k - 3] += step
            assert loss(w, c) > best - 1e-6


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "text"), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    for grades in (none, spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, grade int")):
        rows = toxicity.score_severity(docs, toxicity.fit(docs, grades)).collect()
        assert len(rows) == 4 and all(r.severity < 1e-9 and not r.toxic and r.grade == 0 for r in rows)
    assert toxicity.score_severity(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0


# -- near-duplicates -------------------------------------------------------
def changed(rnd, text, n):
    words = text.split()
    for _ in range(n):
        words[rnd.randrange(len(words))] = rnd.choice(WORDS) + "x"
    return " ".join(words)


def copies_corpus(seed=4):
    rnd = random.Random(seed)
    common = prose(rnd, 60)
    docs = [prose(rnd, rnd.randint(30, 200)) for _ in range(80)]
    docs += [prose(rnd, 60) + " " + common for _ in range(40)]
    docs += [changed(rnd, docs[k % 20], rnd.choice([0, 1, 2, 4, 8])) for k in range(100)]
    base = prose(rnd, 150)
    docs += [base] * 30 + [changed(rnd, base, 1) for _ in range(60)]
    docs += ["one two", "One, two!", "", None, "...", "one two three"]
    order = list(enumerate(docs))
    rnd.shuffle(order)
    return order


def plain_idf(docs, rare=near_dedup.RARE):
    """Idf of every shingle from exact document counts."""
    held, total = collections.Counter(), 0
    for _, text in docs:
        h = near_dedup.Shingler().hashes(near_dedup.words_of(text or ""))
        held.update(set(h.tolist()))
        total += len(h) > 0
    return {h: 1 + np.log(total / n) / np.log(1 / rare) if n > rare * total else 2.0 for h, n in held.items()}


def test_document_counts_are_exact_for_long_texts_too(spark):
    rnd = random.Random(8)
    shared = [f"s{rnd.random()}" for _ in range(300)]
    docs = [(i, " ".join([*(shared if i % 3 else []), *(f"w{rnd.randint(0, 10**9)}" for _ in range(9000))])) for i in range(120)]
    idf = near_dedup.idf_table(spark.createDataFrame(docs, "doc_id long, text string").repartition(8))
    want = plain_idf(docs)
    h = np.array(sorted(want), np.uint64)
    assert idf.common.sum() > 100_000 and np.allclose(idf.of(h), [want[x] for x in h.tolist()])
    assert near_dedup.idf_table(spark.createDataFrame([], "doc_id long, text string")).of(h[:3]).tolist() == [2, 2, 2]
    # In short texts a bucket is as common as its shingles, but for chance.
    short = [(i, " ".join([*(shared[:9] if i % 2 else []), *(f"w{rnd.randint(0, 10**9)}" for _ in range(30))])) for i in range(400)]
    idf = near_dedup.idf_table(spark.createDataFrame(short, "doc_id long, text string").repartition(8))
    want = plain_idf(short)
    h = np.array(sorted(want), np.uint64)
    assert idf.common is None and np.mean(np.isclose(idf.of(h), [want[x] for x in h.tolist()])) > 0.9


def brute_links(spark, docs):
    idf = near_dedup.idf_table(spark.createDataFrame(docs, "doc_id long, text string"))
    shingler, rows = near_dedup.Shingler(), {}
    for i, text in docs:
        h, n, _ = shingler.rows([near_dedup.words_of(text or "")])
        if len(h):
            rows[i] = (h, (n * idf.of(h)).astype(np.float32))
    ids = sorted(rows)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if near_dedup.weighted_jaccard(*rows[a], *rows[b]) >= near_dedup.SIMILARITY]


def classes_of(ids, links):
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicate_classes_equal_brute_force(spark):
    docs = copies_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"node": F.lit(1), "label": F.lit("clash"), "doc": F.lit(2)})
    rows = near_dedup.near_duplicates(df.repartition(5)).collect()
    want = classes_of([i for i, _ in docs], brute_links(spark, docs))
    assert {r.doc: r.class_id for r in rows} == want
    sizes = collections.Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc == r.class_id) for r in rows)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_pairs_inside_a_family_below_the_threshold(spark):
    rnd = random.Random(8)
    own = lambda n: " ".join(f"w{rnd.getrandbits(48):x}" for _ in range(n))
    core = own(480)
    twins = [own(14) for _ in range(150)]
    docs = [(i, f"{core} {twins[i // 2]} {own(26)}") for i in range(300)]
    links = brute_links(spark, docs)
    assert {(2 * k, 2 * k + 1) for k in range(150)} == set(links)
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    assert {r.doc: r.class_id for r in found.collect()} == classes_of([i for i, _ in docs], links)


def test_rarest_keys_meet_for_every_similar_pair():
    rnd = np.random.default_rng(9)
    pool, weights = np.sort(rnd.integers(0, 2**63, 60, dtype=np.uint64) * np.uint64(2)), rnd.choice([1.0, 1.4, 2.0, 4.0], 60).astype(np.float32)
    counts = rnd.integers(1, 9, 1 << near_dedup.BUCKET_BITS)
    sets = [np.sort(rnd.choice(60, rnd.integers(35, 61), replace=False)) for _ in range(150)]
    keys = [near_dedup.rarest_keys(pool[s], weights[s], counts, 0.8) for s in sets]
    sides = [(set(k[left].tolist()), set(k[right].tolist())) for k, left, right, _, _ in keys]
    close = met = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            meets = bool(sides[i][0] & sides[j][1] or sides[i][1] & sides[j][0])
            met += meets
            if near_dedup.weighted_jaccard(pool[a], weights[a], pool[b], weights[b]) >= 0.8:
                close += 1
                assert meets
    assert 50 < close <= met


def test_near_duplicates_with_repeated_and_null_ids(spark):
    text = prose(random.Random(5), 50)
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (1, "another text of its own words here"), (None, None)], "doc_id long, text string")
    rows = sorted((r.doc or 0, r.class_id or 0, r.class_size) for r in near_dedup.near_duplicates(df).collect())
    assert rows == [(0, 0, 1), (0, 1, 3), (1, 1, 1), (1, 1, 3), (1, 1, 3)]
    assert sorted((r.text or "") for r in near_dedup.keep_one(df).collect()) == sorted(["", "another text of its own words here", text])
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0 and near_dedup.keep_one(df.limit(0)).count() == 0


def test_samples_agree_as_often_as_sets_overlap():
    rnd = np.random.default_rng(6)
    sampler = near_dedup.Sampler(samples=4000)
    hashes = np.sort(rnd.integers(0, 2**63, 300, dtype=np.uint64))
    weights = rnd.choice([1.0, 2.0, 5.5], 300).astype(np.float32)
    other = np.where(rnd.random(300) < 0.2, weights * 2, weights).astype(np.float32)
    cut = slice(30, 300)
    for a, wa, b, wb in ((hashes, weights, hashes[cut], weights[cut]), (hashes, weights, hashes, other)):
        drawn = sampler.draw(np.concatenate((a, b)), np.concatenate((wa, wb)), np.array([len(a), len(b)]))
        assert np.mean(drawn[0] == drawn[1]) == pytest.approx(near_dedup.weighted_jaccard(a, wa, b, wb), abs=0.035)


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (200, 100)]
    rows = components.connected_components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert {r.node: r.label for r in rows} == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102, 200)}}


# -- pipeline --------------------------------------------------------------
@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(7)
    docs, labels, item = {}, [], prose(rnd, 40)
    for i in range(240):
        docs[i] = "\n".join(prose(rnd, rnd.randint(10, 40)) for _ in range(rnd.randint(1, 6)))
        labels.append((i, 1, 0))
    for i in range(240, 330):
        docs[i] = junk(rnd, rnd.randint(30, 100))
        labels.append((i, 0, 0))
    planted = {400: docs[3], 401: docs[4] + "\nIts own last line of words.", 402: changed(rnd, docs[5].replace("\n", " "), 1) + " end",
               403: prose(rnd, 30) + " " + item + " " + prose(rnd, 30), 404: "", 405: None}
    docs |= planted
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame = lambda rows, ddl, name: spark.createDataFrame(rows, ddl).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    frame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long", "documents")
    frame(labels, "doc_id long, quality int, toxic int", "labels")
    frame([(0, item)], "item_id long, text string", "benchmark")
    return folder, docs


def test_pipeline_stage_by_stage(spark, corpus):
    import tiktoken

    folder, docs = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, frame, folder)
    assert good.columns == frame.columns
    left = {r.doc_id: r.text for r in good.collect()}
    assert not set(left) & set(range(240, 330)) and set(range(240)) | {400, 401, 402, 403} <= set(left)
    thin = stages["line dedup"](spark, good, folder)
    want = {}
    for i, (t, gone) in plain_dedup(sorted(left.items())).items():
        if t is None or not gone or t != "" or gone < left[i].count("\n") + 1:
            want[i] = t
    assert thin.columns == frame.columns and {r.doc_id: r.text for r in thin.collect()} == want
    apart = stages["near-dedup"](spark, thin, folder)
    kept = classes_of(list(want), brute_links(spark, list(want.items())))
    assert apart.columns == frame.columns and {r.doc_id for r in apart.collect()} == set(kept.values())
    clean = stages["decontamination"](spark, apart, folder)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == set(kept.values()) - {403}
    from tallywell.llm import byte_bpe
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(final) == set(kept.values()) - {403}
    for i, r in final.items():
        ids = library.encode_ordinary(want[i] or "")
        assert r.n_tokens == len(ids) and bytes(r.ids) == b"".join(x.to_bytes(4, "little") for x in ids)
    assert 400 not in final and 402 not in final


def test_last_stage_decodes_every_text(spark):
    texts = {1: "Plain words, 12 of them.\n\n  And   spaces", 2: "na\u00efve \u6f22\u5b57 \U0001f600 <|endoftext|>", 3: "", 4: None, 5: "x" * 5000}
    rows = corpus_pipeline.encode(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens * 4 == len(r.ids) and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_every_stage_takes_an_empty_table(spark, corpus):
    folder, _ = corpus
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0


def test_columns_with_the_names_of_results(spark):
    text = "Good words make a sentence here. Another one follows it."
    rows = [(i, f"{text}\nline {i}\nlast", "x", "y", 9, 8) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality_score string, quality_statistic_words string, dedup_lines int, dedup_removed int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    scored = quality_rules.score_quality(df, quality_rules.fit(df, labels), score_col="quality_score")
    assert scored.columns == [c for c in df.columns if c != "quality_score"] + ["quality_score"]
    assert all(0 <= r.quality_score <= 1 for r in scored.collect())
    done = line_dedup.dedup_lines(df)
    assert done.columns == [c for c in df.columns if not c.startswith("dedup")] + ["dedup_lines", "dedup_removed"]
    assert {r.dedup_lines for r in done.collect()} == {3}
    kept = corpus_pipeline.drop_repeated_lines(spark, df, "")
    assert kept.columns == df.columns and {(r.dedup_lines, r.dedup_removed) for r in kept.collect()} == {(9, 8)}
