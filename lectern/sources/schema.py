"""The corpus schema and how any labelled source is brought into it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import text as tx

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("label", T.IntegerType()),
    ]
)

# Accepted column names per field, the first match wins.
COLUMN_ALIASES: dict[str, tuple[str, ...]] = {
    "id": ("id",),
    "title": ("title", "headline", "head", "heading"),
    "text": ("text", "content", "article", "body", "story"),
    "subject": ("subject", "category", "topic", "section"),
    "date": ("date", "published", "publish_date", "timestamp", "time"),
}


def resolve_column(columns: Iterable[str], accepted: Sequence[str]) -> str | None:
    """The column that carries a field, by accepted name in order, any case."""
    columns = list(columns)
    for wanted in accepted:
        fitting = [name for name in columns if name.lower() == wanted]
        if len(fitting) > 1:
            raise ValueError(f"columns {fitting} differ in case only")
        if fitting:
            return fitting[0]
    return None


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself, or an error that lists its columns; runs no job."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")
    return df


def with_label(df: DataFrame, label: int) -> DataFrame:
    return df.withColumn("label", F.lit(label).cast("int"))


def normalize_schema(df: DataFrame) -> DataFrame:
    """Project a labelled source onto the corpus schema.

    A missing title falls back to the text, other missing fields become typed
    nulls.  The id keeps the type it has in the source, and is left out where the
    source has none, so that a use of it fails at once.  A source without any text
    column, or with two columns that fit one name, is an error.
    """
    found = {field: resolve_column(df.columns, names) for field, names in COLUMN_ALIASES.items()}
    if found["text"] is None:
        raise ValueError(f"no text column among {df.columns}")
    require_columns(df, "label")
    found["title"] = found["title"] or found["text"]
    found["label"] = "label"

    def pick(field: T.StructField) -> Column:
        name = found[field.name]
        source = F.lit(None) if name is None else F.col(f"`{name}`")
        return (source if field.name == "id" else source.cast(field.dataType)).alias(field.name)

    wanted = [f for f in CORPUS_SCHEMA if f.name != "id" or found["id"]]
    return df.select(*(pick(field) for field in wanted))


def union_labelled(sources: dict[int, DataFrame]) -> DataFrame:
    """Bag union of one source per label, by name, then the corpus schema.

    Columns that only some sources have are null elsewhere.
    """
    labelled = [with_label(df, label) for label, df in sources.items()]
    return normalize_schema(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
    )


def union_labelled_strict(sources: dict[int, DataFrame], text_col: str = "text") -> DataFrame:
    """Text and label (double) only; the text column must exist in every source,
    rows without text are dropped.  The id is kept where every source has one."""
    extra = ["id"] if all("id" in df.columns for df in sources.values()) else []
    parts = [
        require_columns(df, text_col).select(
            *extra, F.col(f"`{text_col}`").alias("text"), F.lit(float(label)).alias("label")
        )
        for label, df in sources.items()
    ]
    return drop_invalid(reduce(DataFrame.unionByName, parts))


def drop_invalid(df: DataFrame) -> DataFrame:
    """Rows with a label and a text that is more than spaces."""
    return df.na.drop(subset=["text", "label"]).filter(tx.is_present(F.col("text")))
