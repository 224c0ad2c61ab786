"""The store of versions: add, replace, failed writes, readers of old versions."""

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tallywell.plans.document_run import index_documents, update_documents
from tallywell.sources import corpus, snapshots


def rows(df):
    return sorted((r.k is None, r.k or 0, r.v) for r in df.collect())


def frame(spark, data):
    return spark.createDataFrame(data, "k long, v string")


def test_replacing_keys_rewrites_their_buckets_only(spark, tmp_path):
    path = str(tmp_path / "store")
    assert snapshots.snapshot(spark, path) is None
    one = snapshots.publish(spark, path, {"t": frame(spark, [(i, "old") for i in range(40)] + [(None, "none"), (3, "twice")])}, "k", buckets=8)
    before = snapshots.read_table(spark, one, "t")
    new = frame(spark, [(3, "new"), (100, "added"), (None, "other")])
    keys = spark.createDataFrame([(3,), (100,), (None,), (5,)], "k long")
    two = snapshots.publish(spark, path, {"t": new}, "k", replaced=keys)
    want = [(False, i, "old") for i in range(40) if i not in (3, 5)] + [(False, 3, "new"), (False, 100, "added"), (True, 0, "other")]
    assert rows(snapshots.read_table(spark, two, "t")) == sorted(want)
    assert two.version == 2 and snapshots.snapshot(spark, path).tables == two.tables
    touched = {r[0] for r in keys.select(F.pmod(F.xxhash64("k"), F.lit(8))).collect()}
    same = {b for b, f in two.tables["t"]["folders"].items() if one.tables["t"]["folders"].get(b) == f}
    assert same == {b for b in one.tables["t"]["folders"] if int(b) not in touched}
    # The reader of the first version sees what it saw.
    assert len(rows(before)) == 42 and len(rows(snapshots.read_table(spark, snapshots.snapshot(spark, path, 1), "t"))) == 42


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "store")
    snapshots.publish(spark, path, {"a": frame(spark, [(1, "x")]), "b": frame(spark, [])}, "k")

    def fail(batches):
        raise RuntimeError("lost")
        yield

    broken = frame(spark, [(2, "y")]).mapInArrow(fail, "k long, v string")
    with pytest.raises(PythonException):
        snapshots.publish(spark, path, {"a": frame(spark, [(1, "z")]), "b": broken}, "k", replaced=frame(spark, [(1, "")]))
    held = snapshots.snapshot(spark, path)
    assert held.version == 1 and rows(snapshots.read_table(spark, held, "a")) == [(False, 1, "x")]
    assert snapshots.read_table(spark, held, "b").count() == 0
    with pytest.raises(ValueError):
        snapshots.publish(spark, path, {"a": frame(spark, [])}, "k", replaced=frame(spark, [(1, "")]))


def test_documents_are_added_and_replaced_with_chunks_and_vectors(spark, tmp_path):
    store = str(tmp_path / "index")
    kinds = "doc_id string, text string, source string"
    index_documents(spark.createDataFrame([("a", "First text. It stays.", "a.txt"), ("b", "Second text. It goes.", "b.txt")], kinds), store)
    old = corpus.load_corpus(spark, store)[1]
    update_documents(spark.createDataFrame([("b", "Other words entirely.", "b.txt"), ("c", "Third text.", "c.txt")], kinds), store)
    docs, chunks = corpus.load_corpus(spark, store)
    assert {r.doc_id: r.text for r in docs.collect()} == {"a": "First text. It stays.", "b": "Other words entirely.", "c": "Third text."}
    assert {r.doc_id: r.text for r in chunks.collect()}["b"] == "Other words entirely."
    vectors, info = corpus.load_embeddings(spark, store)
    assert sorted(r.doc_id for r in vectors.collect()) == ["a", "b", "c"] and info.first()["num_chunks"] == 3
    assert {r.doc_id: r.text for r in old.collect()} == {"a": "First text. It stays.", "b": "Second text. It goes."}
    with pytest.raises(FileNotFoundError):
        corpus.load_corpus(spark, str(tmp_path / "none"))
