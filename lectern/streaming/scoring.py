"""Cleaning, de-duplication and scoring of arriving documents.

Cleaning and scoring look at one row at a time, so the batch functions apply
unchanged.  A model too large for a task needs a join, which is made batch by batch.
De-duplication keeps the digests of recent texts as state, up to a watermark.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lectern.functions import text as tx
from lectern.operators.clean import clean_text
from lectern.operators.models import batch_score
from lectern.operators.scoring import LinearScorer, score_texts


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """New files under ``path`` as they arrive, with a fixed schema."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def score_stream(docs: DataFrame, model: LinearScorer | PipelineModel) -> DataFrame:
    """Clean and score a stream with a table-backed linear model or fitted stages."""
    cleaned = clean_text(docs)
    if isinstance(model, LinearScorer):
        if not model.size.small:
            raise ValueError("a model beyond the lookup bounds scores a stream by score_batches")
        return score_texts(cleaned, model)
    return batch_score(model, cleaned, *docs.columns)


def dedup_stream(docs: DataFrame, time_col: str, delay: str, per: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct text among those that arrive within ``delay`` of each other.

    The first to arrive stays.  State holds a digest per text and is dropped once
    the watermark has passed its time by ``delay``; a copy that comes later than that
    stays, and a row older than the watermark is dropped.  ``per`` names columns
    that must be equal as well, such as the source.
    """
    marked = docs.withWatermark(time_col, delay).withColumn("_digest", tx.content_digest(F.col("text")))
    return marked.dropDuplicatesWithinWatermark(["_digest", *per]).drop("_digest")


def write_batch(scored: DataFrame, batch_id: int, out_path: str) -> None:
    """Write a batch as a partition of its own; the same batch again replaces it."""
    numbered = scored.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(out_path)


def score_batches(
    docs: DataFrame, model: LinearScorer, out_path: str, checkpoint_path: str
) -> StreamingQuery:
    """Clean and score all that has arrived by a linear model of any size, then stop.

    Each batch is scored as a table, so a large model meets its words in a join.
    A batch that is run again after a failure replaces what it wrote, so every row
    is in the output once.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        write_batch(score_texts(clean_text(batch), model), batch_id, out_path)

    return (
        docs.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def run_available(scored: DataFrame, out_path: str, checkpoint_path: str) -> StreamingQuery:
    """Score everything that has arrived since the last call, then stop.

    The checkpoint makes a rerun go on where the last one stopped; the parquet
    sink commits each batch once.
    """
    return (
        scored.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
