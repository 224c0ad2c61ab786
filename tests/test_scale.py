"""What grows with the input: work and tasks of single steps, and their results."""

import dataclasses
import random
import sys
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from test_text import bm25, plain_lists, zipf_docs

from tallywell.operators import blocksearch, impact, lexical
from tallywell.plans import registry


def test_begun_scores_join_the_lists():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n, k = int(rng.integers(1, 5000)), int(rng.integers(1, 12))
        lists = plain_lists(rng, n, 8)
        plain, begun = np.zeros(n), np.zeros(n)
        for i, (q, own, w, *_) in enumerate(lists):
            plain[own] += q * w
            begun[own] += q * w * (i < 3)
        ids, scores, _ = impact.top_rows(lists[3:], n, k, None, begun)
        order = np.lexsort((np.arange(n), -plain))[:k]
        assert ids.tolist() == order.tolist() and scores == pytest.approx(plain[order])


@dataclasses.dataclass
class CountedMeasure(impact.Measure):
    folder: str = ""

    def weights(self, counts, rows, lengths, norms):
        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(rows)))
        return super().weights(counts, rows, lengths, norms)


def test_postings_reach_a_shard_once_for_thousands_of_questions(spark, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rng = random.Random(8)
    words, docs = zipf_docs(rng, 200)
    asked = [("q%04d" % i, " ".join(rng.choices(words, k=6))) for i in range(2_500)]
    index = lexical.lexical_index(spark.createDataFrame(docs, "text string, doc_id long"), ["doc_id"])
    questions = spark.createDataFrame(asked, "query_id string, question string")
    measure = CountedMeasure(lexical.K1, lexical.B, index.avg_length, str(tmp_path))
    hits = impact.impact_topk(index.postings, measure, questions, lexical._bm25_weights(index, questions), 5)
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    for q, question in asked[::50]:
        assert got[q] == [i for i, _ in bm25(question, docs)[:5]]
    assert len(list(tmp_path.iterdir())) == index.postings.shards == 1


def test_few_rows_are_recomputed_once_a_bar_is_reached():
    rng = np.random.default_rng(2)
    corpus, asked = rng.normal(size=(6_000, 8)), rng.normal(size=(40, 8))
    looked = []

    class Counted(blocksearch.DenseQueries):
        def ranks(self, batch):
            out = super().ranks(batch)
            looked.append(np.isfinite(out).sum())
            return out

    def table(name, x):
        return pa.table({name: pa.array(range(len(x)), pa.int64()), "vector": pa.array(x.tolist())})

    scorer = Counted(table("query_id", asked), "l2", 5)
    parts = [table("id", corpus).slice(a, 100) for a in range(0, 6_000, 100)]
    frame = blocksearch._task_topk(parts, scorer, ["id"], 5, None).sort_values(["q", "rank"], ascending=[True, False])
    apart = ((asked[:, None, :] - corpus[None]) ** 2).sum(axis=2)
    for q in range(40):
        assert frame[frame["q"] == q]["id"].tolist() == np.argsort(apart[q], kind="stable")[:5].tolist()
    # Without the bar every slice of 100 rows gave 5 rows of each question or more.
    assert sum(looked) < 60 * 40 * 5 / 3


def test_files_of_a_scan_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "FILES_PER_TASK", 10)
    pages = spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(200)], "page_id long, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    seen = []
    frame = type(pages)
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *c: seen.append(n) or plain(self, n, *c))
    got = {r["page_id"]: r["text_length"] for r in registry.queries()["scan_pages_raw"](spark, str(tmp_path)).collect()}
    assert got == {i: len(f"<p>{i}</p>") for i in range(200)}
    assert 20 in seen


def test_chunk_vectors_are_stored_before_they_are_searched(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} and more words.", "en", f"a/{i}.txt") for i in range(20)],
                                 "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    turns = spark.createDataFrame([(1, 0, "user", "word3 and")], "conv_id long, turn int, role string, text string")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    given = []
    plain = registry.answers.retrieve_auto
    monkeypatch.setattr(registry.answers, "retrieve_auto", lambda q, **k: given.append(k["vectors"]) or plain(q, **k))
    assert registry.queries()["retrieve_auto"](spark, str(tmp_path)).count() == 5
    assert all("/vectors-" in f for f in given[0].inputFiles())
