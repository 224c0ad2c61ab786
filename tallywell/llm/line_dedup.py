"""Line dedup with overlapping windows of three lines, in DataFrame functions only.

Every run of three lines of a text is a window. A window that stands in the
corpus more than once is kept where it comes first, by document id and line,
and all its later places are covered; covered lines go, each once however many
windows cover it.

Two 64-bit hashes name a window. Hashes that occur once leave after one
aggregation that combines before its shuffle, so a window shared by a third of
all documents costs each task one row. The texts meet the covered lines in one
join on the document.

Cases: a null text, a text of fewer than three lines and a window of three
blank lines are left as they are; lines differ if a character differs; rows
with the same id and text are one document and share its result; rows with the
same id and another text are other documents, of which the smaller hash comes
first; a text all of whose lines go becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import quoted

WINDOW = 3


def _line_hashes(text: Column) -> Column:
    """Per line its two hashes and whether it is blank."""
    return F.transform(F.split(text, "\n"), lambda line: F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"), (F.trim(line) == "").alias("blank")))


def _windows(lines: Column) -> Column:
    """Per window its two hashes and its first line; windows of blank lines are left out."""
    own = [lambda i, k=k: F.element_at(lines, i + k) for k in range(1, WINDOW + 1)]

    def window(i):
        parts = [part(i) for part in own]
        blank = parts[0]["blank"]
        for part in parts[1:]:
            blank = blank & part["blank"]
        return F.struct(F.xxhash64(*[p["a"] for p in parts]).alias("a"), F.xxhash64(*[p["b"] for p in parts]).alias("b"),
                        i.alias("line"), blank.alias("blank"))

    places = F.when(F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    return F.filter(F.transform(places, window), lambda w: ~w["blank"])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counts: tuple[str, str] = ("dedup_lines", "dedup_removed")) -> DataFrame:
    """All columns of ``df``, the text without covered lines, and ``counts``: lines, and lines removed.

    The counts take the place of columns of their names.
    """
    text, doc = F.col(quoted(text_col)), F.col(quoted(id_col))
    places = (df.select(doc.alias("doc"), F.xxhash64(text).alias("version"), _line_hashes(text).alias("lines"))
              .select("doc", "version", F.inline(_windows(F.col("lines")))).drop("blank"))
    place = F.struct("doc", "version", "line")
    first = (places.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where(F.col("first") != F.col("last")).drop("last"))
    covered = (places.join(first, ["a", "b"]).where(place != F.col("first"))
               .groupBy("doc", "version").agg(F.collect_set("line").alias("hit")))
    columns = [F.col(quoted(c)) for c in df.columns]
    joined = (df.select(F.struct(*columns).alias("row"), doc.alias("doc"), F.xxhash64(text).alias("version"))
              .join(covered.withColumnsRenamed({"doc": "hit_doc", "version": "hit_version"}),
                    F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("version") == F.col("hit_version")), "left"))
    row_text = F.col("row").getField(text_col)
    gone = F.array_distinct(F.flatten(F.transform("hit", lambda i: F.sequence(i, i + WINDOW - 1))))
    # Lines and covered lines are columns of their own: a lambda would split the text again for every line.
    cut = joined.select("row", F.split(row_text, "\n").alias("lines"), gone.alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    new_text = F.when(F.col("gone").isNull(), row_text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at("lines", i + 1)), "\n"))
    return cut.select(
        *[(new_text if c == text_col else F.col("row").getField(c)).alias(c) for c in df.columns
          if c.lower() not in [n.lower() for n in counts]],
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias(counts[0]),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias(counts[1]))
