"""Chunking, search and answers against brute force on small data."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.functions import text
from tallywell.operators import answers, chunking, impact, lexical, vectors
from tallywell.operators.blocksearch import block_topk
from tallywell.sources import corpus


def plain_chunks(body, limit=1000):
    """The fold over sentences as a plain loop, one document."""
    sents = [s for s in re.split(r"(?<=[.!?])\s+", body.rstrip()) if s]
    out, cur, size = [], [], 0
    for s in sents:
        if size + len(s) > limit:
            if cur:
                out.append(cur)
            cur = cur[-3:] + [s]
            size = len(" ".join(cur))
        else:
            cur = cur + [s]
            size += len(s)
    return [" ".join(c) for c in (out + [cur] if cur else out)]


def chunk_texts(spark, body):
    df = chunking.chunk_documents(spark.createDataFrame([(1, body)], "doc_id long, text string"))
    return [r["text"] for r in df.orderBy("pos").collect()]


def test_chunks_follow_the_fold(spark):
    rng = random.Random(1)
    bodies = ["", "   ", "One.", "x" * 2000, " ".join("abc"[i % 3] * 899 + "." for i in range(4)),
              " ".join("a." for _ in range(900)), "No end. " + "y" * 1500 + "! Short? Tail"]
    bodies += [" ".join("w" * rng.randint(1, 400) + rng.choice(".!?") for _ in range(60)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    got = {}
    for r in chunking.chunk_documents(df).orderBy("doc_id", "pos").collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, body in enumerate(bodies):
        assert [r["text"] for r in got.get(i, [])] == plain_chunks(body)
    many = got[5][0]
    assert many["start_idx"] == 2 * (many["text"].count(".") - 200)
    stats = {r["doc_id"]: r["num_chunks"] for r in chunking.document_stats(df).collect()}
    assert stats == {i: len(plain_chunks(b)) for i, b in enumerate(bodies)}


def test_carried_long_sentences_grow_chunks(spark):
    got = chunk_texts(spark, " ".join(c * 899 + "." for c in "abcd"))
    assert [len(g) for g in got] == [900, 1801, 2702, 3603]


def test_readding_a_document_keeps_both_chunk_sets(spark):
    one = spark.createDataFrame([(1, "Old."), (2, "Same.")], "doc_id long, text string")
    two = spark.createDataFrame([(1, "New one. More.")], "doc_id long, text string")
    chunks, docs = chunking.union_chunks([one, two])
    assert sorted(r["text"] for r in chunks.collect()) == ["New one. More.", "Old.", "Same."]
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == {1: "New one. More.", 2: "Same."}


CORPUS = [("the cat sat on the mat", 0), ("the dog", 1), ("a cat and a dog and a cat", 2), ("", 3),
          ("quite other words", 4), ("the the the the", 5), ("cat", 6), ("the dog", 7)]
ASKED = [("q1", "cat dog"), ("q2", "the"), ("q3", "nothing here matches"), ("q4", "cat cat the dog"), ("q5", "")]


def bm25(question, docs):
    toks = [d.split() for d, _ in docs]
    n, avg = len(docs), sum(map(len, toks)) / len(docs)
    vocab = {t for d in toks for t in d}
    df = {t: sum(t in d for d in toks) for t in vocab}
    idf = {t: math.log(n - df[t] + .5) - math.log(df[t] + .5) for t in vocab}
    floor = .25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    out = []
    for d, (_, i) in zip(toks, docs):
        s = sum(idf.get(t, 0) * d.count(t) * 2.5 / (d.count(t) + 1.5 * (.25 + .75 * len(d) / avg)) for t in question.split())
        out.append((-round(s, 6), i))
    return [(i, -s) for s, i in sorted(out)]


@pytest.mark.parametrize("limit", [128, 1])
def test_bm25_equals_brute_force_both_ways(spark, limit):
    docs = spark.createDataFrame(CORPUS, "text string, doc_id long")
    asked = spark.createDataFrame(ASKED, "query_id string, question string")
    index = lexical.lexical_index(docs, ["doc_id"])
    got = {}
    for r in lexical.search_bm25(index, asked, 3, per_cell=limit).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    for q, words in ASKED:
        want = bm25(words, CORPUS)[:3]
        assert [d for d, _ in got[q]] == [d for d, _ in want]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want], abs=1e-6)


def tfidf(question, docs):
    toks = [[t for t in d.split() if len(t) > 1] for d, _ in docs]
    df = {t: sum(t in d for d in toks) for d in toks for t in d}

    def vector(words):
        v = {t: words.count(t) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in words if t in df}
        n = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / n for t, x in v.items()}

    q = vector([t for t in question.split() if len(t) > 1])
    scored = [(-round(sum(x * q.get(t, 0) for t, x in vector(d).items()), 6), i) for d, (_, i) in zip(toks, docs)]
    return [(i, -s) for s, i in sorted(scored)]


@pytest.mark.parametrize("limit", [128, 1])
def test_tfidf_equals_brute_force_both_ways(spark, limit):
    docs = spark.createDataFrame(CORPUS, "text string, doc_id long")
    asked = spark.createDataFrame(ASKED, "query_id string, question string")
    index = lexical.lexical_index(docs, ["doc_id"], text.VECTOR_TOKEN)
    rows = lexical.search_tfidf(index, asked, 2, per_cell=limit).orderBy("query_id", "rank").collect()
    for q, words in ASKED:
        assert [(r["doc_id"], pytest.approx(r["score"], abs=1e-6)) for r in rows if r["query_id"] == q] == tfidf(words, CORPUS)[:2]
    strict = lexical.search_tfidf(index, asked, 2, threshold=0.01, per_cell=limit)
    assert strict.filter("query_id = 'q3'").count() == 0


def zipf_docs(rng, count, words=30):
    names = ["w%d" % i for i in range(words)]
    docs = [(" ".join(rng.choices(names, [1 / (i + 1) for i in range(words)], k=rng.randint(0, 40))), i) for i in range(count)]
    return names, docs


@pytest.mark.parametrize("limit,rows", [(128, 50), (7, 32_768)])
def test_several_shards_and_cells(spark, monkeypatch, limit, rows):
    monkeypatch.setattr(impact, "LEAST_ROWS", rows)
    monkeypatch.setattr(impact, "SHARD_ROWS", rows)
    rng = random.Random(5)
    words, docs = zipf_docs(rng, 200)
    asked = [("q%02d" % i, " ".join(rng.choices(words, k=12))) for i in range(40)]
    index = lexical.lexical_index(spark.createDataFrame(docs, "text string, doc_id long").repartition(5), ["doc_id"])
    questions = spark.createDataFrame(asked, "query_id string, question string")
    got = {}
    for r in lexical.search_bm25(index, questions, 5, per_cell=limit).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    assert index.postings.shards == (1 if rows > 200 else 4)
    for q, question in asked:
        assert got[q] == [i for i, _ in bm25(question, docs)[:5]]
    floors = lexical.lexical_index(spark.createDataFrame(docs, "text string, doc_id long"), ["doc_id"], text.VECTOR_TOKEN)
    for floor in (0.0, 0.3, 0.7):
        rows_ = lexical.search_tfidf(floors, questions, 6, threshold=floor, per_cell=limit).orderBy("query_id", "rank").collect()
        for q, question in asked:
            assert [r["doc_id"] for r in rows_ if r["query_id"] == q] == [i for i, s in tfidf(question, docs) if s >= floor][:6]


def plain_lists(rng, n, terms, negative=False):
    lists = []
    for _ in range(terms):
        ids = np.sort(rng.choice(n, max(1, int(n / rng.integers(1, 20))), replace=False)).astype(np.int32)
        w = rng.integers(1, 9, len(ids)) / 4.0
        starts = np.arange(0, len(ids), impact.BLOCK)
        ends = ids[np.append(starts[1:], len(ids)) - 1]
        lists.append((float(rng.integers(-3 if negative else 0, 9)), ids, w, ends, np.maximum.reduceat(w, starts), w.max()))
    return lists


@pytest.mark.parametrize("few,lookup", [(8_192, 4_096), (1, 0), (50, 0)])
@pytest.mark.parametrize("floor", [None, 0.0, 12.0])
def test_top_rows_are_exact_and_skip_most(monkeypatch, few, lookup, floor):
    monkeypatch.setattr(impact, "FEW", few)
    monkeypatch.setattr(impact, "LOOKUP", lookup)
    rng = np.random.default_rng(3)
    for trial in range(150):
        n, k = int(rng.integers(1, 3000)), int(rng.integers(1, 12))
        lists = plain_lists(rng, n, int(rng.integers(0, 9)), trial % 3 == 0)
        ids, scores, _ = impact.top_rows(list(lists), n, k, floor)
        plain = np.zeros(n)
        for q, own, w, *_ in lists:
            plain[own] += q * w
        order = [i for i in np.lexsort((np.arange(n), -plain)) if floor is None or plain[i] >= floor][:k]
        assert ids.tolist() == order and scores == pytest.approx(plain[order])
    monkeypatch.setattr(impact, "LOOKUP", 4_096)
    rare = np.arange(0, 60_000, 3000, dtype=np.int32)
    common = np.arange(60_000, dtype=np.int32)
    blocks = np.append(np.arange(0, 60_000, impact.BLOCK)[1:], 60_000) - 1
    lists = [(5.0, rare, np.ones(20), rare[-1:], np.ones(1), 1.0), (0.1, common, np.ones(60_000), blocks.astype(np.int32), np.ones(len(blocks)), 1.0)]
    assert impact.top_rows(lists, 60_000, 5)[2] <= 40


def test_effort_is_far_below_the_rows(spark):
    rng = random.Random(6)
    _, docs = zipf_docs(rng, 3000, 2000)
    index = lexical.lexical_index(spark.createDataFrame(docs, "text string, doc_id long"), ["doc_id"])
    asked = spark.createDataFrame([("a", "w5 w700 w1200"), ("b", "w900"), ("c", "zzz")], "query_id string, question string")
    cells = {r.query_id: r.cells for r in lexical.bm25_effort(index, asked).collect()}
    assert cells["c"] == 0 and cells["b"] < 300 and cells["a"] < 1500


@pytest.mark.parametrize("limit", [4_000_000, 8])
def test_nearest_vectors_equal_brute_force_both_ways(spark, limit):
    rng = random.Random(2)
    data = [(i, [float(rng.randint(-2, 2)) for _ in range(4)]) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, vector array<float>").repartition(6)
    asked = df.filter("vec_id < 7").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in vectors.knn_l2(df, asked, ["vec_id"], 9, limit).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["distance"]))
    for q in range(7):
        want = sorted((sum((a - b) ** 2 for a, b in zip(v, data[q][1])), i) for i, v in data)[:9]
        assert got[q] == [(i, d) for d, i in want]
    cos = vectors.search_cosine(df, asked, ["vec_id"], 400, 0.0, limit)
    for q in range(7):
        def cosine(v):
            n = math.sqrt(sum(a * a for a in v) * sum(a * a for a in data[q][1]))
            return round(sum(a * b for a, b in zip(v, data[q][1])) / n, 6) if n else 0.0
        assert cos.filter(F.col("query_id") == q).count() == sum(cosine(v) >= 0 for _, v in data)
    for r in vectors.similarity_summary(df, asked, ["vec_id"], 0.0, limit).collect():
        assert r["n_scored"] == 300 and r["n_similar"] == cos.filter(F.col("query_id") == r["query_id"]).count()


def test_more_neighbours_keep_the_first(spark):
    df = spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(50)], "vec_id long, vector array<float>")
    asked = df.filter("vec_id = 3").withColumnRenamed("vec_id", "query_id")
    few = [r["vec_id"] for r in vectors.knn_l2(df, asked, ["vec_id"], 4).orderBy("rank").collect()]
    more = [r["vec_id"] for r in vectors.knn_l2(df, asked, ["vec_id"], 5).orderBy("rank").collect()]
    assert more[:4] == few == [3, 8, 13, 18]
    assert vectors.knn_l2(df, asked, ["vec_id"], 500).count() == 50


def test_blank_text_is_a_zero_vector(spark):
    df = vectors.embed_text(spark.createDataFrame([("",), ("  ",), (None,), ("a b",), ("a b",)], "text string"))
    rows = [list(r["vector"]) for r in df.collect()]
    assert all(sum(map(abs, v)) == 0 for v in rows[:3]) and rows[3] == rows[4] and len(rows[3]) == 256
    chunks = spark.createDataFrame([("1", " "), (None, "x"), ("", "x"), ("2", "x")], "chunk_id string, text string")
    assert [r["chunk_id"] for r in vectors.embed_chunks(chunks).collect()] == ["2"]


def extract(spark, question, context):
    df = spark.createDataFrame([(question, context)], "question string, context string")
    r = answers.with_answer(df).first()
    return r["answer"], r["confidence"]


def test_answer_extraction(spark):
    assert extract(spark, "What is the Churn rate", "Intro here. The CHURN\n rate is low! Churn rate again.") == \
        ("the churn rate is low", 1.0)
    assert extract(spark, "churn? now", "About churn only.") == ("about churn only", 0.1)
    assert extract(spark, "what is the", "First. Second.") == ("first", 0.1)
    assert extract(spark, "cat", "") == ("", 0.1)
    assert extract(spark, "cat", None) == ("", 0.1)
    assert extract(spark, "red cat", "a cat. a red dog. red cats")[1] == 0.5


def test_answers_from_a_document_everyone_asks(spark):
    asked = spark.createDataFrame([(f"q{i:03d}", f"colour number {i}") for i in range(300)] + [("none", "x")],
                                  "query_id string, question string")
    docs = spark.createDataFrame([(1, " ".join(f"colour {i} is here." for i in range(300))), (2, "nothing.")],
                                 "doc_id long, text string")
    hits = asked.filter("query_id <> 'none'").select(
        "query_id", F.lit(1).cast("long").alias("doc_id"), F.lit(0.5).alias("score"), F.lit(1).alias("rank"))
    got = {r["query_id"]: r for r in answers.answer_questions(asked, hits, docs, per_copy=16).collect()}
    assert len(got) == 301
    assert got["none"]["answer"] == answers.NO_DOCUMENT and got["none"]["confidence"] == 0.0
    for i in range(300):
        assert got[f"q{i:03d}"]["answer"] == f"colour {i} is here"
        assert got[f"q{i:03d}"]["confidence"] == pytest.approx(0.333334, abs=2e-6)


def test_sentence_match_in_pieces_takes_the_first_best(monkeypatch):
    import pyarrow as pa

    from tallywell.operators import sentencematch
    rng = random.Random(4)
    sents = [rng.choices("abcdefgh", k=rng.randint(0, 5)) for _ in range(60)]
    asked = [rng.sample("abcdefghxyz", rng.randint(0, 6)) for _ in range(25)]
    for cells in (30, 10**6):
        monkeypatch.setattr(sentencematch, "CELLS", cells)
        hits, place = sentencematch.match(pa.array(sents, pa.list_(pa.string())), pa.array(asked, pa.list_(pa.string())))
        for q, h, p in zip(asked, hits, place):
            counts = [len(set(q) & set(s)) for s in sents]
            assert (h, p) == (max(counts), counts.index(max(counts)))


def test_zero_scores_give_an_empty_answer(spark):
    asked = spark.createDataFrame([("q", "cat")], "query_id string, question string")
    docs = spark.createDataFrame([(1, "cat.")], "doc_id long, text string")
    hits = asked.select("query_id", F.lit(1).cast("long").alias("doc_id"), F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    row = answers.answer_questions(asked, hits, docs).first()
    assert (row["answer"], row["confidence"], row["doc_id"]) == ("", 0.0, None)


def test_sources_and_normalized_scores(spark):
    asked = spark.createDataFrame([("q", "cat"), ("lost", "dog")], "query_id string, question string")
    docs = spark.createDataFrame([(1, "/a/b.txt", "b.txt"), (2, "c.md", "c.md")], "doc_id long, source string, title string")
    chunks = spark.createDataFrame([(1, 0, "The cat sat."), (2, 0, "No.")], "doc_id long, pos int, text string")
    hits = spark.createDataFrame([("q", 1, 0, 2.0, 1), ("q", 2, 0, 0.5, 2)],
                                 "query_id string, doc_id long, pos int, score double, rank int")
    got = {r["query_id"]: r for r in answers.answer_with_sources(asked, hits, chunks, docs).collect()}
    assert got["q"]["answer"] == "the cat sat" and [s["normalized_score"] for s in got["q"]["sources"]] == [1.0, 0.25]
    assert got["lost"]["answer"] == answers.NO_CHUNK and got["lost"]["sources"] == []
    zero = lexical.normalized_scores(hits.withColumn("score", F.lit(0.0)))
    assert {r["normalized_score"] for r in zero.collect()} == {None}
    lines = answers.source_references(
        spark.createDataFrame([("q", "yes"), ("lost", "no")], "query_id string, answer string"),
        hits.join(docs, "doc_id"))
    assert {r["query_id"]: r["formatted"] for r in lines.collect()} == {
        "q": "yes\n\nSources:\n[1] b.txt (score: 2.00)\n[2] c.md (score: 0.50)", "lost": "no"}


def test_retrieval_falls_back(spark):
    asked = spark.createDataFrame([("q", "cat")], "query_id string, question string")
    assert answers.retrieve_auto(asked).first()["reply"] == answers.NO_INDEX
    chunks = spark.createDataFrame([(1, 0, "cat"), (2, 0, "dog")], "doc_id long, pos int, text string")
    index = lexical.lexical_index(chunks, ["doc_id", "pos"])
    assert answers.retrieve_auto(asked, 1, index=index).first()["score"] == 0.0  # idf of 1 in 2 is 0
    vecs = vectors.embed_text(chunks).select("doc_id", "pos", "vector")
    top = answers.retrieve_auto(asked, 1, vectors=vecs, index=index).first()
    assert top["doc_id"] == 1 and top["score"] == 1.0


def test_titles_dates_extensions(spark):
    df = spark.createDataFrame([("", "/x/y.TXT", {"created": "c"}), (None, "z", {"creation_date": "", "created": "c"}),
                                ("T", ".bashrc", {})], "title string, source string, m map<string,string>")
    rows = df.select(text.default_title(F.col("title"), F.col("source")).alias("t"),
                     text.document_date(F.col("m")).alias("d"), text.extension(F.col("source")).alias("e")).collect()
    assert [tuple(r) for r in rows] == [("y.TXT", "c", ".txt"), ("z", "", ""), ("T", None, "")]


def test_corpus_files(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    for name, body in [("a.txt", "Alpha.\nTwo."), ("deep/B.MD", "Beta"), ("deep/er/c.html", "<b>x</b>"),
                       ("deep/e.txt", ""), ("d.pdf", "no")]:
        (tmp_path / name).write_text(body)
    got = {r["source"].rsplit("/", 1)[-1]: r["text"] for r in corpus.read_corpus(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "Alpha.\nTwo.", "B.MD": "Beta"}
    html = corpus.read_corpus(spark, str(tmp_path), [".HTML"]).collect()
    assert [r["text"] for r in html] == ["<b>x</b>"]
    one = corpus.file_document(spark, str(tmp_path / "a.txt"))
    assert one.first()["doc_id"] == "a.txt"
    path = corpus.save_corpus(one, str(tmp_path / "store"))
    docs, chunks = corpus.load_corpus(spark, path)
    assert docs.first()["title"] == "a.txt" and chunks.first()["chunk_id"] == "a.txt:0"


def test_chunk_json_skips_bad_rows(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"chunk_id": "1", "text": "t", "metadata": {"k": "v"}}\n'
                                     '{"chunk_id": "", "text": "t"}\n{"chunk_id": "2"}\nnot json\n')
    rows = corpus.read_chunks_json(spark, str(tmp_path), lines=True).collect()
    assert [(r["chunk_id"], r["metadata"]) for r in rows] == [("1", {"k": "v"})]
    assert corpus.unreadable_chunks(spark, str(tmp_path), lines=True).first()["record"] == "not json"


def test_chunk_json_in_every_layout(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "chunk_id": "1",\n  "text": "one"\n}\n')
    (tmp_path / "b.json").write_text('{"chunk_id": "2", "text": "two", "metadata": {"k": "v"}}')
    (tmp_path / "c.json").write_text('[\n  {"chunk_id": "3", "text": "three"},\n  {"chunk_id": "4", "text": "four"}\n]')
    (tmp_path / "d.json").write_text('{"chunk_id": "5", "text": ')
    rows = corpus.read_chunks_json(spark, str(tmp_path)).collect()
    assert sorted((r["chunk_id"], r["text"]) for r in rows) == [("1", "one"), ("2", "two"), ("3", "three"), ("4", "four")]
    assert [r["source"][-6:] for r in corpus.unreadable_chunks(spark, str(tmp_path)).collect()] == ["d.json"]


def test_an_index_without_vectors_does_not_answer_by_old_ones(spark, tmp_path):
    from tallywell.plans.document_run import answer_batch, index_documents
    schema, store = "doc_id string, text string, source string", str(tmp_path / "store")
    asked = spark.createDataFrame([("1", "when do trains leave")], "query_id string, question string")
    index_documents(spark.createDataFrame([("a", "Cats sleep all day.", "a")], schema), store)
    new = [(f"d{i}", t, f"d{i}") for i, t in enumerate(["Trains leave at noon.", "Rain falls.", "Snow melts.", "Cats run."])]
    index_documents(spark.createDataFrame(new, schema), store, with_vectors=False)
    assert answer_batch(spark, store, asked, k=1).first()["answer"] == "trains leave at noon"


@pytest.mark.parametrize("scale", [1e-4, 1.0, 1e4, 1e7])
@pytest.mark.parametrize("limit", [4_000_000, 20])
def test_nearest_vectors_at_any_scale(spark, scale, limit):
    import numpy as np
    x = np.random.default_rng(3).normal(size=(400, 8)) * scale + 1000 * scale
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "vec_id long, vector array<double>").repartition(5)
    asked = df.where("vec_id < 4").withColumnRenamed("vec_id", "query_id")
    rows = vectors.knn_l2(df, asked, ["vec_id"], 5, query_limit=limit).collect()
    for q in range(4):
        d = ((x - x[q]) ** 2).sum(axis=1)
        want = sorted(range(400), key=lambda i: (d[i], i))[:5]
        mine = sorted((r["rank"], r["vec_id"], r["distance"]) for r in rows if r["query_id"] == q)
        assert [v for _, v, _ in mine] == want
        assert [v for _, _, v in mine] == pytest.approx(d[want], rel=1e-9)


def test_vectors_of_another_model_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("1", [1.0, 2.0], {})], "chunk_id string, vector array<float>, metadata map<string,string>")
    path = corpus.save_embeddings(df, str(tmp_path / "v"), "m1")
    assert corpus.load_embeddings(spark, path, "m1")[1].first()["embedding_size"] == 2
    with pytest.raises(ValueError):
        corpus.load_embeddings(spark, path, "m2")


def test_index_and_ask(spark, tmp_path):
    from tallywell.plans.document_run import answer_batch, index_directory
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("Cats sleep all day. Dogs bark at night.")
    (tmp_path / "in" / "b.txt").write_text("Trains leave at noon. Buses never leave.")
    # A term in half of all chunks has a BM25 weight of 0, hence more files.
    (tmp_path / "in" / "c.txt").write_text("Rain falls.")
    (tmp_path / "in" / "d.md").write_text("Snow melts.")
    asked = spark.createDataFrame([("1", "when do trains leave"), ("2", "who is it that sleep like cats")],
                                  "query_id string, question string")
    for with_vectors in (True, False):
        store = index_directory(spark, str(tmp_path / "in"), str(tmp_path / f"store{with_vectors}"),
                                with_vectors=with_vectors)
        got = {r["query_id"]: r for r in answer_batch(spark, store, asked, k=1).collect()}
        assert got["1"]["answer"] == "trains leave at noon" and got["1"]["sources"][0]["title"] == "b.txt"
        assert got["2"]["answer"] == "cats sleep all day" and got["2"]["confidence"] > 0.1
