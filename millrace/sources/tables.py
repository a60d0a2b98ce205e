"""Table scans, stage tables, report export, fitted models, inventory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import to_number
from millrace.session import col

ROW_ORDER = ("_file", "_block", "_row")

# Words a CSV cell may use for "missing".
MISSING_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    encoding: str | None = "UTF-8",
    sep: str = ",",
    keep_order: bool = False,
    keep_corrupt: bool = False,
    multi_line: bool = False,
    missing_words: Sequence[str] = MISSING_WORDS,
) -> DataFrame:
    """Scan CSV as text; typing belongs to the cleaning step.

    ``encoding=None`` probes the bytes (UTF-8, else latin-1). ``keep_order``
    adds file, block and row columns that together give the file order under
    any partitioning, for operators that keep the first row of a key.
    A doubled quote inside a quoted cell is one quote. ``multi_line`` allows line breaks inside
    quoted cells; such a file cannot be split, so each is read by one task.
    ``keep_corrupt`` adds ``_corrupt_record`` for lines that do not fit.
    """
    if encoding is None:
        encoding = detect_encoding(spark, path)
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("escape", '"').option("multiLine", multi_line)
    if columns is not None:
        schema = text_schema(columns)
        if keep_corrupt:
            schema = schema.add("_corrupt_record", T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record").option("mode", "PERMISSIVE")
        reader = reader.schema(schema)
    df = reader.csv(path)
    if missing_words:
        texts = [c for c in df.columns if c != "_corrupt_record"]
        order = ["_metadata"] if keep_order else []
        known = {c: F.when(~col(c).isin(*missing_words), col(c)).alias(c) for c in texts}
        df = df.select(*[known.get(c, col(c)) for c in df.columns], *order)
    if keep_order:
        df = df.select(
            *[col(c) for c in df.columns if c != "_metadata"],
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
    return df


def typed_by_content(df: DataFrame, skip: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Turn text columns that hold nothing but numbers into doubles, found by one aggregate."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    if not texts:
        return df
    aggs = []
    for i, c in enumerate(texts):
        aggs += [F.count(col(c)).alias(f"n{i}"), F.count(to_number(col(c))).alias(f"k{i}")]
    row = df.agg(*aggs).first()
    numeric = [c for i, c in enumerate(texts) if 0 < row[f"n{i}"] == row[f"k{i}"]]
    return df.withColumns({c: to_number(col(c)) for c in numeric}) if numeric else df


def detect_encoding(spark: SparkSession, path: str | Sequence[str]) -> str:
    """UTF-8 when every line is valid UTF-8, else latin-1; lines are checked in parallel."""
    lines = spark.read.option("encoding", "UTF-8").text(path)
    broken = lines.where(~F.is_valid_utf8("value")).limit(1).count()
    return "ISO-8859-1" if broken else "UTF-8"


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a stage table; Parquet keeps types and characters that a CSV hop would lose."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Export a report table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def keep_for_reuse(df: DataFrame) -> DataFrame:
    """Hold a table with several consumers for the run, spilling to disk rather than failing."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("dataset"), "filas", F.lit(len(df.columns)).alias("columnas")
        )
        out = row if out is None else out.unionByName(row)
    return out
