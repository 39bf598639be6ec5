"""Postings from a stream of chunk files (an extension; all else is batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslens.functions.text import normalize, word_tokens
from corpuslens.operators.search import postings


def stream_postings(spark: SparkSession, chunks: str, schema: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's postings to ``out``; a batch that runs again overwrites its own folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        records = batch.select(F.col("chunk_id").alias("record"), word_tokens(normalize(F.col("text"))).alias("tokens"))
        postings(records).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    stream = spark.readStream.schema(schema).parquet(chunks)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
