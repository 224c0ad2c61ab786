"""Tabular sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Texts that stand for a missing value in CSV.
MISSING_WORDS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                 "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# What an unquoted empty CSV field reads as, so that it differs from a quoted one.
EMPTY_FIELD = "\u0001missing"

INTEGER = r"^\s*[+-]?\d{1,18}\s*$"
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"


def load_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str | None = None,
               multiline: bool = True, missing: Sequence[str] = MISSING_WORDS) -> DataFrame:
    """Read a customer table; NaN is read as NULL.

    CSV has a header row. An unquoted empty field and the words ``missing`` are
    NULL, a quoted empty field is an empty string. Types are found in one extra
    pass unless a schema is given: whole numbers, numbers, true/false, else
    text. Quoted line breaks are part of a field; a file is then read by one
    task. ``multiline=False`` lets Spark split large files that have none.
    """
    fmt = fmt or ("csv" if path.rstrip("/").lower().endswith(".csv") else "parquet")
    if fmt == "csv":
        return nan_to_null(_read_csv(spark, path, schema, multiline, list(missing)))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return nan_to_null(reader.format(fmt).load(path))


def _read_csv(spark, path, schema, multiline, missing) -> DataFrame:
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multiline, "nullValue": EMPTY_FIELD,
               "emptyValue": "", "enforceSchema": False}
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    texts = reader.csv(path)
    plain = {c: F.col(quoted(c)) for c in texts.columns}
    texts = texts.select(*[F.when(~v.isin(missing), v).alias(c) if missing else v for c, v in plain.items()])
    if schema is not None:
        return texts.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    return texts.select(*[F.col(quoted(c)).cast(kind).alias(c) for c, kind in _found_types(texts).items()])


def _found_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest type that every value of a column has; text without a value."""
    checks = []
    for i, c in enumerate(texts.columns):
        v = F.col(quoted(c))
        checks += [F.count(v).alias(f"n{i}"), F.count_if(v.rlike(INTEGER)).alias(f"bigint{i}"),
                   F.count_if(v.rlike(DECIMAL)).alias(f"double{i}"),
                   F.count_if(F.lower(F.trim(v)).isin("true", "false")).alias(f"boolean{i}")]
    seen = texts.agg(*checks).first()
    return {c: next((k for k in ("bigint", "double", "boolean") if seen[f"n{i}"] and seen[f"{k}{i}"] == seen[f"n{i}"]),
                    "string") for i, c in enumerate(texts.columns)}


def quoted(name: str) -> str:
    """A column name as Spark reads it whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes NULL, the one missing value used everywhere else."""
    floating = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floating:
        return df
    return df.withColumns({c: F.when(~F.isnan(quoted(c)), F.col(quoted(c))) for c in floating})


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet table ``name`` below ``base``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header row, one part file per partition; NULL is an empty
    field and an empty string a quoted one."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue='""')
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines; NULL fields are kept so every record has the same keys."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
