"""Searches, scans and fits on more rows: less work for each pair, memory by size, same results."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from test_text import bm25, zipf_docs

from tallywell.operators import blocksearch, impact, lexical, training
from tallywell.plans import pipeline, registry
from tallywell.sources import corpus


def visit_of(rng, n, terms, many, negative=False):
    """A cell of random postings and questions, and the scores of every pair."""
    lists = [np.sort(rng.choice(n, max(1, int(n * rng.uniform(0, 1) ** 4)), replace=False)) for _ in range(terms)]
    value = [rng.integers(1, 9, len(x)) / 4.0 for x in lists]
    at = np.cumsum([0, *map(len, lists)])
    asked = [np.sort(rng.choice(terms, rng.integers(0, min(9, terms) + 1), replace=False)) for _ in range(many)]
    weight = [rng.integers(-3 if negative and q % 3 == 0 else 1, 9, len(x)) / 3.0 for q, x in enumerate(asked)]
    scores = np.zeros((many, n))
    for q, (own, w) in enumerate(zip(asked, weight)):
        for c, x in zip(own, w):
            scores[q, lists[c]] += x * value[c]
    owner, code, w = np.repeat(np.arange(many), [len(x) for x in asked]), np.concatenate(asked), np.concatenate(weight)
    some = w != 0
    return impact.Visit(n, at, np.concatenate(lists), np.concatenate(value), many, owner[some], code[some], w[some]), scores


@pytest.mark.parametrize("fast,few,rows", [(160, 16_384, 16_384), (1e9, 16, 256), (0, 1, 256)])
@pytest.mark.parametrize("floor", [None, 0.0, 4.0])
def test_best_rows_of_a_cell_are_exact(monkeypatch, fast, few, rows, floor):
    monkeypatch.setattr(impact, "FAST", fast)
    monkeypatch.setattr(impact, "FEW", few)
    monkeypatch.setattr(impact, "MANY_ROWS", rows)
    monkeypatch.setattr(impact, "SUMS", 20_000)
    monkeypatch.setattr(impact, "PAIRS", 50)
    rng = np.random.default_rng(5)
    for trial in range(60):
        n, k = int(rng.integers(1, 3_000)), int(rng.integers(1, 12))
        visit, scores = visit_of(rng, n, int(rng.integers(1, 20)), int(rng.integers(1, 30)), trial % 2 == 0)
        found = {}
        for who, ids, best, _ in visit.best(k, floor):
            for q, i, s in zip(who.tolist(), ids.tolist(), best.tolist()):
                found.setdefault(q, []).append((i, s))
        # Thirds and quarters: equal sums may differ in their last bits, the twelve digits do not.
        plain = impact.settled(scores)
        for q in range(len(plain)):
            order = [int(i) for i in np.lexsort((np.arange(n), -plain[q])) if floor is None or plain[q, i] >= floor][:k]
            assert [i for i, _ in found.get(q, [])] == order
            assert [s for _, s in found.get(q, [])] == pytest.approx(plain[q, order].tolist())


def test_questions_of_a_cell_are_added_up_together(monkeypatch):
    """before, every question went over the cell's rows several times by itself, as doubles."""
    calls = []
    plain = impact.top_rows
    monkeypatch.setattr(impact, "top_rows", lambda *a, **b: calls.append(1) or plain(*a, **b))
    rng = np.random.default_rng(1)
    n, many = 20_000, 200
    lists = [np.sort(rng.choice(n, n // (2 + 3 * c), replace=False)) for c in range(30)]
    value = [rng.random(len(x)) + 0.1 for x in lists]
    asked = [np.sort(rng.choice(30, 8, replace=False)) for _ in range(many)]
    owner, code, w = np.repeat(np.arange(many), 8), np.concatenate(asked), rng.random(8 * many) + 0.01
    visit = impact.Visit(n, np.cumsum([0, *map(len, lists)]), np.concatenate(lists), np.concatenate(value), many, owner, code, w)
    scores = np.zeros((many, n))
    for q, c, x in zip(owner, code, w):
        scores[q, lists[c]] += x * value[c]
    got = [(q, i) for who, ids, *_ in visit.best(5, None) for q, i in zip(who.tolist(), ids.tolist())]
    assert got == [(q, int(i)) for q in range(many) for i in np.argsort(-scores[q], kind="stable")[:5]]
    assert not calls


def test_shards_are_bounded_by_the_size_of_their_texts(spark, monkeypatch):
    """F9, F10, F8: long texts made shards whose tokens and postings no executor could hold."""
    rng = random.Random(3)
    words, docs = zipf_docs(rng, 60)
    monkeypatch.setattr(impact, "SHARD_SIZE", sum(len(t) for t, _ in docs) // 9)
    index = lexical.lexical_index(spark.createDataFrame(docs, "text string, doc_id long"), ["doc_id"])
    assert 9 <= index.postings.shards <= 11
    asked = [("q%d" % i, " ".join(rng.choices(words, k=5))) for i in range(20)]
    got = {}
    for r in lexical.search_bm25(index, spark.createDataFrame(asked, "query_id string, question string")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    for q, question in asked:
        assert got[q] == [i for i, _ in bm25(question, docs)[:5]]


def test_a_shard_holds_no_tokens():
    """F9, F10, F8: batches are counted as they come; rows and lists go on over them."""
    tokens = [["b", "a", "b"], [], None, ["a"], ["c", "b"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(tokens, pa.list_(pa.string())), pa.array([0, 0, 0, 0, 1], pa.int32())],
                                       names=["doc_id", "tokens", "shard"])
    parts = dict(impact._by_shard(iter([batch.slice(0, 1), batch.slice(1, 2), batch.slice(3)])))
    assert [len(p) for p in parts.values()] == [3, 1]
    numbers = pa.list_(pa.int32())
    arrow = pa.schema([("shard", pa.int32()), ("term", pa.string()), ("ids", numbers), ("counts", numbers), ("lengths", numbers),
                       ("keys_0", pa.list_(pa.int64()))])
    rows = pa.Table.from_batches(list(impact._postings(0, parts[0], ["doc_id"], arrow))).to_pylist()
    assert rows[0]["lengths"] == [3, 0, 0, 1] and rows[0]["keys_0"] == [0, 1, 2, 3]
    assert {r["term"]: (r["ids"], r["counts"]) for r in rows[1:]} == {"b": ([0], [2]), "a": ([0, 3], [1, 1])}


def near_table(name, x):
    return pa.table({name: pa.array(range(len(x)), pa.int64()), "vector": pa.array(x.tolist(), pa.list_(pa.float64()))})


@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e14, 1e17])
@pytest.mark.parametrize("held,tile", [(10_000, (512, 2_048)), (100, (7, 5))])
def test_nearest_rows_are_exact_by_bounds_of_single_floats(monkeypatch, scale, held, tile):
    monkeypatch.setattr(blocksearch, "HELD_ROWS", held)
    monkeypatch.setattr(blocksearch, "TILE", tile)
    rng = np.random.default_rng(7)
    corpus, asked = rng.integers(-3, 4, (1_500, 6)) * scale, rng.integers(-3, 4, (20, 6)) * scale
    corpus[::50] *= 100
    corpus[700:760] = corpus[0] + rng.normal(size=(60, 6)) * scale * 1e-6
    asked[0], asked[1] = corpus[0], 0
    apart = ((asked[:, None, :] - corpus[None]) ** 2).sum(axis=2)
    for k in (1, 5, 2_000):
        scorer = blocksearch.DenseQueries(near_table("query_id", asked), "l2", k)
        parts = [near_table("id", corpus).slice(a, 300) for a in range(0, 1_500, 300)]
        frame = blocksearch._task_topk(parts, scorer, ["id"], k, None).sort_values(["q", "rank", "id"], ascending=[True, False, True])
        for q in range(20):
            want = np.lexsort((np.arange(1_500), blocksearch.settled(apart[q])))[:k]
            assert frame[frame["q"] == q]["id"].tolist()[:k] == want.tolist()


def test_distances_of_a_task_are_bounded_by_single_floats(monkeypatch):
    """before, every pair got a distance as doubles and went through a dozen passes."""
    rng = np.random.default_rng(8)
    corpus, asked = rng.random((4_000, 64)), rng.random((300, 64))
    pairs = []
    plain = blocksearch.DenseQueries._distances
    monkeypatch.setattr(blocksearch.DenseQueries, "_distances", lambda self, x, q, row: pairs.append(len(q)) or plain(self, x, q, row))
    monkeypatch.setattr(blocksearch.DenseQueries, "ranks", lambda *a: pytest.fail("all pairs as doubles"))
    scorer = blocksearch.DenseQueries(near_table("query_id", asked), "l2", 5)
    frame = blocksearch._task_topk([near_table("id", corpus)], scorer, ["id"], 5, None).sort_values(["q", "rank"], ascending=[True, False])
    apart = ((asked[:, None, :] - corpus[None]) ** 2).sum(axis=2)
    for q in range(300):
        assert frame[frame["q"] == q]["id"].tolist() == np.argsort(apart[q], kind="stable")[:5].tolist()
    assert 300 * 5 <= sum(pairs) < 300 * 10


def corpus_of_files(folder, n):
    for i in range(n):
        at = folder / f"group{i % 7}" / f"deep[{i % 3}]"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"n{i}.txt").write_text(f"text {i}\n")
    (folder / "group0" / "own.MD").write_text("beside folders")
    (folder / "top.txt").write_text("at the top")
    (folder / "group1" / "other.pdf").write_text("no text")
    (folder / "group1" / "empty.txt").write_text("")
    (folder / "_hidden").mkdir()
    (folder / "_hidden" / "a.txt").write_text("not read")
    (folder / "flat.txt").mkdir()
    (folder / "flat.txt" / "in.txt").write_text("in a folder named like a file")


@pytest.mark.parametrize("listed", [50_000, 12, 1])
def test_files_are_listed_in_groups(spark, tmp_path, monkeypatch, listed):
    """before, the driver held the list of all files, and a task read four of them."""
    monkeypatch.setattr(corpus, "LISTED_FILES", listed)
    corpus_of_files(tmp_path, 60)
    groups = corpus._folder_groups(spark, str(tmp_path))
    assert sum(n for _, n, _ in groups) >= 63 and (len(groups) == 1 or all(n <= max(listed, 3) for _, n, _ in groups))
    rows = corpus.read_corpus(spark, str(tmp_path))
    assert rows.columns == ["doc_id", "text", "source"]
    got = {r["source"].rsplit("/", 1)[-1]: r["text"] for r in rows.collect()}
    assert got == {f"n{i}.txt": f"text {i}\n" for i in range(60)} | {
        "own.MD": "beside folders", "top.txt": "at the top", "in.txt": "in a folder named like a file"}
    assert rows.count() == 63 and all(r["doc_id"] == r["source"] for r in rows.collect())
    one = corpus.read_corpus(spark, str(tmp_path / "top.txt")).collect()
    assert [r["text"] for r in one] == ["at the top"]
    assert corpus.read_corpus(spark, f"{tmp_path}/group[25]").count() == 17


def test_few_tasks_read_many_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for i in range(400):
        (tmp_path / "a" / f"{i}.txt").write_text("x")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        assert corpus.read_corpus(spark, str(tmp_path)).rdd.getNumPartitions() <= 32
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scanned_files_hold_the_rows(spark, tmp_path):
    """rows of one key are lines of one file; empty and missing texts are no documents."""
    rows = [(1, "a\nb\n"), (2, ""), (3, None), (4, "é中"), (5, "x"), (5, "x"), (6, "\r\n ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.queries()["scan_corpus"](spark, str(tmp_path)).collect()
    want = {1: "a\nb\n", 4: "é中", 5: "x\nx", 6: "\r\n "}
    assert {r["doc_id"]: (r["text_length"], r["text_md5"]) for r in got} == {
        k: (len(t), hashlib.md5(t.encode()).hexdigest()) for k, t in want.items()}


def test_risk_run_scores_the_rows_once(spark, tmp_path, monkeypatch):
    """before, the best model was evaluated twice and every row was scored twice."""
    calls = []
    for name in ("evaluate_model", "score"):
        plain = getattr(training, name)
        monkeypatch.setattr(training, name, lambda *a, name=name, plain=plain: calls.append(name) or plain(*a))
    compare = training.compare_models
    monkeypatch.setattr(training, "compare_models", lambda *a: compare(*a, kinds=["LogisticRegression"]))
    rng = random.Random(1)
    rows = [(i, rng.random(), rng.choice("ab"), int(i % 3 == 0)) for i in range(120)]
    df = spark.createDataFrame([(i, x + y, c, y) for i, x, c, y in rows], "customer_id long, x double, c string, Churn int")
    writes = []
    plain_csv = pipeline.tables.write_csv
    monkeypatch.setattr(pipeline.tables, "write_csv", lambda d, to: writes.append(d.inputFiles()) or plain_csv(d, to))
    run = pipeline.run_risk_pipeline(spark, df, str(tmp_path), skip_exploration=True)
    # One to compare, and one score of it and one of all rows; explanations score through their own name.
    assert calls == ["evaluate_model", "score", "score"]
    assert all("/scored-" in f for f in writes[0])
    best = run.metrics.first()
    stored = spark.read.json(f"{tmp_path}/model_metadata").first()["performance"]
    assert stored["roc_auc"] == best["roc_auc"] and stored["accuracy"] == best["accuracy"]
    assert spark.read.csv(run.predictions_path, header=True).count() == 120
