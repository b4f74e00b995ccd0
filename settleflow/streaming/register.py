"""Document backfill as a stream.

The register is meant to be brought up to date every few minutes. New document files are read as a
stream, so a run looks at what has arrived since the last one instead of scanning thirty days again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from settleflow.sources.tables import append_rows


def due_documents(documents: DataFrame, claims: DataFrame, register: DataFrame) -> DataFrame:
    """Documents of known claims that have no register row yet."""
    return documents.join(claims.select("claim_code"), "claim_code", "left_semi").join(register.select("claim_code"), "claim_code", "left_anti")


def register_new_documents(spark: SparkSession, documents_path: str, schema: StructType, claims_path: str, register_path: str,
                           progress_path: str, status_id: int = 2) -> StreamingQuery:
    """Process all document files that arrived since the last run, then stop.

    ``progress_path`` holds the stream's progress and must be on shared storage, as the tables are. A
    batch that is repeated after a failure adds nothing: its claims are in the register by then.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        due = due_documents(batch, session.read.parquet(claims_path), session.read.parquet(register_path))
        rows = due.select("document_id", "claim_code", F.lit(status_id).alias("status_id"), F.col("filed_at").alias("updated_at"), F.lit(True).alias("is_active"))
        append_rows(rows, register_path)

    return (
        spark.readStream.schema(schema).parquet(documents_path)
        .writeStream.foreachBatch(write).option("checkpointLocation", progress_path).trigger(availableNow=True).start()
    )
