"""Scoring requests that arrive as JSON lines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators.models import score_batch


def parse_requests(lines: DataFrame) -> DataFrame:
    """``value`` text to ``pedido`` (its ``id`` field, else the hash of the text), the ten request
    fields, and ``motivo``: why there is no answer, or null."""
    parsed = lines.select(
        "value",
        F.coalesce(F.get_json_object("value", "$.id"), F.sha2("value", 256)).alias("pedido"),
        F.from_json("value", schemas.REQUEST).alias("r"),
        F.get_json_object("value", "$").isNotNull().alias("json"),
    )
    missing = F.array_compact(
        F.array(*[F.when(F.col(f"r.{c}").isNull(), F.lit(c)) for c in schemas.FEATURES])
    )
    reason = F.when(~F.col("json"), "not json").when(
        F.size(missing) > 0, F.concat(F.lit("missing or mistyped: "), F.array_join(missing, ", "))
    )
    return parsed.select("value", "pedido", "r.*", reason.alias("motivo"))


def score_available(
    spark: SparkSession,
    model: PipelineModel,
    requests: str,
    output: str,
    checkpoint: str,
    threshold: float = 0.5,
    rejected: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Answer every request file that has not been answered yet, then stop. Requests without an
    answer go to ``rejected`` with their text, id and reason, if that is given. Each micro-batch
    has a folder of its own, which a repeated batch overwrites; ``max_files`` bounds it."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream

    def write(batch: DataFrame, number: int) -> None:
        parsed = parse_requests(batch)
        good = parsed.filter("motivo is null")
        answers = score_batch(good, model, threshold, ["pedido", *schemas.FEATURES])
        answers.write.mode("overwrite").parquet(f"{output}/lote={number}")
        if rejected:
            bad = parsed.filter("motivo is not null").select("pedido", "value", "motivo")
            bad.write.mode("overwrite").parquet(f"{rejected}/lote={number}")

    query = (
        reader.text(requests)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(output).drop("lote")
