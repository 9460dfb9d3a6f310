"""Readers: labelled CSV sources, scoring input, literal text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.sources.schema import require_columns, union_labelled, union_labelled_strict

# File name of each class inside a dataset folder.
CLASS_FILES: dict[int, str] = {1: "True.csv", 0: "Fake.csv"}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with quoted line breaks and doubled quotes, all strings.

    No inference pass runs over the data.  A file with quoted line breaks cannot
    be split, so large sources should come as many files under ``path``.
    """
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')


def preview(spark: SparkSession, path: str, rows: int = 10) -> DataFrame:
    return read_csv(spark, path).limit(rows)


def open_sources(spark: SparkSession, folder: str) -> dict[int, DataFrame]:
    """One raw frame per class file.  Spark reports a missing file, on any
    file system it can reach."""
    return {
        label: read_csv(spark, f"{folder.rstrip('/')}/{name}")
        for label, name in CLASS_FILES.items()
    }


def load_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Open, label, unite and normalise the class files of a folder.

    Each file is read by one task, as quoted line breaks allow no split, and its
    rows are then spread over tasks by their size.
    """
    return union_labelled(open_sources(spark, folder)).hint("rebalance")


def load_texts_and_labels(
    spark: SparkSession, real_path: str, fake_path: str, text_col: str = "text"
) -> DataFrame:
    """Text and label only, from two named files."""
    sources = {1: read_csv(spark, real_path), 0: read_csv(spark, fake_path)}
    return union_labelled_strict(sources, text_col)


def scoring_input(df: DataFrame, text_col: str = "text", id_col: str | None = "id") -> DataFrame:
    """Texts to be scored: trimmed, blank ones skipped, the id kept if there is one."""
    names = [text_col] + ([id_col] if id_col else [])
    require_columns(df, *names)
    ids = [F.col(f"`{id_col}`").alias("id")] if id_col else []
    text = tx.strip_ends(F.col(f"`{text_col}`")).alias("text")
    return df.select(*ids, text).filter(F.col("text") != "")


def read_scoring_csv(
    spark: SparkSession, path: str, text_col: str = "text", id_col: str | None = None
) -> DataFrame:
    return scoring_input(read_csv(spark, path), text_col, id_col)


def literal_text(spark: SparkSession, *texts: str) -> DataFrame:
    """A few given texts as scoring input, numbered from 0."""
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")


def read_reports(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """The reports recorded in a folder, a row per model and run; ``run_id`` is text
    whatever it looks like."""
    reader = spark.read.schema(schema) if schema else spark.read
    # Partition values are typed by the reader's guess unless the schema names them.
    found = reader.json(folder)
    if dict(found.dtypes).get("run_id") == "string":
        return found
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if f.name != "run_id"]
    return spark.read.schema(", ".join([*fields, "run_id string"])).json(folder)
