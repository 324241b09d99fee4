"""Live inference (G4): JSON records from a stream are scored by a saved bundle.

Every micro-batch writes its scores and its dead letters to folders named by the batch's
id, replacing what is there: a batch that is run again after a failure leaves the same
rows, once.  A record that can't be read, or lacks a number, goes to the dead letters
with its text and the reason; it never stops the stream."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bundles import LinearBundle


def judge(records: DataFrame, payload: str, bundle: LinearBundle) -> DataFrame:
    """Adds the bundle's features (read from the JSON text ``payload``), probability,
    pred, status and reason (NULL where the record is scored)."""
    fields = ", ".join(f"`{n}` double" for n in bundle.features)
    told = records.withColumn("_record", F.from_json(payload, f"{fields}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    value = lambda n: F.col("_record").getField(n)
    lacking = F.concat_ws(", ", *[F.when(value(n).isNull() | F.isnan(value(n)) | (F.abs(value(n)) == float("inf")), n) for n in bundle.features])
    reason = F.when(F.col(payload).isNull() | F.col("_record._corrupt").isNotNull() | F.col("_record").isNull(), "unreadable").when(lacking != "", F.concat(F.lit("lacks "), lacking))
    scored = told.withColumn("reason", reason).select("*", *[F.when(F.col("reason").isNull(), value(n)).alias(n) for n in bundle.features])
    scored = scored.withColumn("probability", bundle.probability())
    hit = F.when(F.col("reason").isNull(), bundle.verdict(F.col("probability")))
    return scored.withColumn("pred", hit).withColumn("status", F.when(hit == 1, "FAILURE RISK").when(hit == 0, "normal")).drop("_record")


def score_batch(payload: str, bundle: LinearBundle) -> Callable[[DataFrame, int, str], None]:
    """A ``foreachBatch`` writer of scores and dead letters, idempotent by batch id."""
    def fn(batch: DataFrame, batch_id: int, out: str) -> None:
        told = judge(batch, payload, bundle).persist()
        try:
            told.where("reason is null").drop(payload, "reason").write.mode("overwrite").parquet(f"{out}/scores/batch={batch_id}")
            told.where("reason is not null").select(*batch.columns, "reason").write.mode("overwrite").parquet(f"{out}/dead/batch={batch_id}")
        finally:
            told.unpersist()
    return fn


def score_live(stream: DataFrame, payload: str, bundle: LinearBundle, path: str) -> None:
    """Scores everything that has arrived into ``path``; run again, it goes on where
    it stopped."""
    write = score_batch(payload, bundle)
    query = (stream.writeStream.outputMode("append").option("checkpointLocation", f"{path}/_checkpoint")
             .foreachBatch(lambda batch, i: write(batch, i, path)).trigger(availableNow=True).start())
    query.awaitTermination()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/scores").drop("batch")


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/dead").drop("batch")
