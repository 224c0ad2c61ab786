"""Document sources, and stores for documents, chunks and vectors."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions.text import basename, default_title, document_date, extension
from tallywell.operators.chunking import chunk_documents
from tallywell.session import scratch_path, staged
from tallywell.sources.snapshots import publish, read_table, snapshot

# Files listed at once, as Spark's driver holds what it lists; files and bytes of one task.
LISTED_FILES, TASK_FILES, TASK_BYTES = 50_000, 500, 67_108_864

TEXT_EXTENSIONS = (".txt", ".md", ".html", ".htm")
DEFAULT_EXTENSIONS = (".txt", ".md")

CHUNK_SCHEMA = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def read_corpus(spark: SparkSession, path: str, extensions: Sequence[str] = DEFAULT_EXTENSIONS) -> DataFrame:
    """Text files below ``path``, any depth, as ``(doc_id, text, source)``.

    The extension is matched in any case; markup is kept as it is; empty files
    are dropped. ``doc_id`` is the full path.

    Spark's driver holds the list of the files it reads. Of more than
    ``LISTED_FILES`` files the texts are therefore read by groups of folders and
    written to the shared folder now; only the files directly in one folder are
    always listed together.
    """
    wanted = [e.lower() for e in extensions if e.lower() in TEXT_EXTENSIONS]
    groups = _folder_groups(spark, path)
    if groups is None:
        return _read_texts(spark, path, wanted)
    if len(groups) == 1:
        return _read_texts(spark, path, wanted, *groups[0][1:])
    out = scratch_path(spark, "texts")
    texts = None
    for paths, files, size in groups:
        texts = _read_texts(spark, paths, wanted, files, size)
        # One group's list is let go before the next is made.
        texts.write.mode("append").parquet(out)
    return spark.read.schema(texts.schema).parquet(out)


def _read_texts(spark: SparkSession, paths: str | list[str], wanted: list[str], files: int = 0, size: int = 0) -> DataFrame:
    either = ["*." + "".join(f"[{ch}{ch.upper()}]" for ch in e[1:]) for e in wanted]
    # The glob keeps other files from being listed and read at all.
    reader = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "{" + ",".join(either) + "}"))
    if not isinstance(paths, str):
        # Names of folders that were listed are no patterns.
        reader = reader.option("__globPaths__", "false")
    found = reader.text(paths, wholetext=True)
    if files:
        # Spark gives a task few small files; most of its time would be the task's own.
        found = found.coalesce(max(4 * spark.sparkContext.defaultParallelism, -(-files // TASK_FILES), -(-size // TASK_BYTES)))
    return (found.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))
            .filter(extension(F.col("source")).isin(wanted) & (F.col("text") != ""))
            .select(F.col("source").alias("doc_id"), "text", "source"))


def _folder_groups(spark: SparkSession, path: str) -> list[tuple[list[str], int, int]] | None:
    """Paths that together hold all files below ``path``, in groups of few files, with the number and bytes of these;
    None for a pattern of paths."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(top):
        return None
    groups: list[tuple[list[str], int, int]] = []

    def add(paths: list[str], n: int, size: int) -> None:
        if groups and groups[-1][1] + n <= LISTED_FILES:
            held, m, bytes_ = groups.pop()
            paths, n, size = held + paths, m + n, bytes_ + size
        groups.append((paths, n, size))

    def walk(folder, held) -> None:
        below = [s for s in files.listStatus(folder) if _is_read(s.getPath().getName())]             if held.getFileCount() > LISTED_FILES and held.getDirectoryCount() > 1 else []
        if not any(s.isDirectory() for s in below):
            if held.getFileCount():
                add([folder.toString()], held.getFileCount(), held.getLength())
            return
        for s in below:
            if s.isDirectory():
                walk(s.getPath(), files.getContentSummary(s.getPath()))
            else:
                add([s.getPath().toString()], 1, s.getLen())

    walk(top, files.getContentSummary(top))
    return groups or None


def _is_read(name: str) -> bool:
    """Spark passes over names such as ``_temporary`` and ``.hidden``."""
    return not (name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_"))


def file_document(spark: SparkSession, path: str, doc_id: str | None = None) -> DataFrame:
    """One file as a document; its id is the file name unless given."""
    name = F.lit(doc_id) if doc_id is not None else basename(F.col("source"))
    return (read_corpus(spark, path, TEXT_EXTENSIONS)
            .select(name.alias("doc_id"), "text", "source"))


def document_records(docs: DataFrame) -> DataFrame:
    """Complete ``docs`` to the document record: title, author, date, metadata."""
    def given(c, kind="string"):
        return F.col(c) if c in docs.columns else F.lit(None).cast(kind)

    metadata = F.coalesce(given("metadata", "map<string,string>"), F.create_map().cast("map<string,string>"))
    title = F.coalesce(given("title"), F.try_element_at(metadata, F.lit("title")))
    return docs.select(
        "doc_id", "text", "source", default_title(title, F.col("source")).alias("title"),
        F.coalesce(given("author"), F.try_element_at(metadata, F.lit("author"))).alias("author"),
        F.coalesce(given("date"), document_date(metadata)).alias("date"), metadata.alias("metadata"))


CORRUPT = "_corrupt_record"


def _chunk_records(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    schema = T.StructType([*CHUNK_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).json(path, mode="PERMISSIVE", multiLine=not lines, columnNameOfCorruptRecord=CORRUPT)


def read_chunks_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Chunk records from JSON files. A file is one document, an object or an
    array of objects, in any layout; with ``lines`` each line is one.

    Rows without text or id are skipped, and so is what cannot be read;
    :func:`unreadable_chunks` names that.
    """
    rows = _chunk_records(spark, path, lines)
    return rows.filter(F.col(CORRUPT).isNull() & (F.col("chunk_id") != "") & (F.col("text") != "")).drop(CORRUPT)


def unreadable_chunks(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``(source, chunk_id, record)`` of what :func:`read_chunks_json` could not read."""
    return (_chunk_records(spark, path, lines).filter(F.col(CORRUPT).isNotNull())
            .select(F.col("_metadata.file_path").alias("source"), "chunk_id", F.col(CORRUPT).alias("record")))


def write_chunks_json(chunks: DataFrame, path: str) -> str:
    chunks.select("chunk_id", "text", "metadata").write.mode("overwrite").json(path)
    return path


def _corpus_tables(documents: DataFrame) -> dict[str, DataFrame]:
    records = staged(document_records(documents), "records")
    return {"documents": records, "chunks": chunk_documents(records)}


def save_corpus(documents: DataFrame, path: str) -> str:
    """Store document records and their chunks as a new version below ``path``; what was there is no part of it."""
    publish(documents.sparkSession, f"{path}/corpus", _corpus_tables(documents), "doc_id")
    return path


def add_documents(documents: DataFrame, path: str) -> str:
    """Add documents and their chunks to a stored corpus; a document of an id that is there takes its place.

    Only the buckets of these ids are rewritten. Of several rows with one id all are kept.
    """
    tables = _corpus_tables(documents)
    publish(documents.sparkSession, f"{path}/corpus", tables, "doc_id", replaced=tables["documents"])
    return path


def load_corpus(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents and chunks of the latest version, or of one before."""
    held = _held(spark, f"{path}/corpus", version)
    return read_table(spark, held, "documents"), read_table(spark, held, "chunks")


def _held(spark: SparkSession, path: str, version: int | None):
    held = snapshot(spark, path, version)
    if held is None:
        raise FileNotFoundError(f"{path} holds no version{'' if version is None else f' {version}'}")
    return held


def save_embeddings(vectors: DataFrame, path: str, model_name: str, key: str = "chunk_id") -> str:
    """Store ``(id, vector, metadata)`` rows and the name of their model as a new version."""
    publish(vectors.sparkSession, f"{path}/embeddings", {"vectors": vectors}, key, note=_about(model_name))
    return path


def add_embeddings(vectors: DataFrame, path: str, model_name: str, key: str = "chunk_id", replaced: DataFrame | None = None) -> str:
    """Add rows of the stored model; those of the same keys, or of the keys ``replaced``, give way."""
    spark = vectors.sparkSession
    _same_model(_held(spark, f"{path}/embeddings", None).note, model_name)
    publish(spark, f"{path}/embeddings", {"vectors": vectors}, key, replaced=vectors if replaced is None else replaced,
            note=_about(model_name))
    return path


def _about(model_name: str) -> dict[str, str]:
    return {"model_name": model_name, "created_at": datetime.now(timezone.utc).isoformat()}


def _same_model(note: dict[str, str], model_name: str) -> None:
    if note["model_name"] != model_name:
        raise ValueError(f"vectors were made by {note['model_name']!r}, not {model_name!r}")


def load_embeddings(spark: SparkSession, path: str, model_name: str | None = None,
                    version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored vectors and a row about them. A ``model_name`` other than the
    stored one is an error: its vectors could not be compared."""
    held = _held(spark, f"{path}/embeddings", version)
    if model_name is not None:
        _same_model(held.note, model_name)
    vectors = read_table(spark, held, "vectors")
    info = vectors.agg(F.count("*").alias("num_chunks"), F.max(F.size("vector")).alias("embedding_size")).select(
        F.lit(held.note["model_name"]).alias("model_name"), "embedding_size", "num_chunks",
        F.lit(held.note["created_at"]).cast("timestamp").alias("created_at"))
    return vectors, info
