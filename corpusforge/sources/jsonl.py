"""JSON-lines inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..schemas import DOCUMENT, METADATA, QA_PAIR
from ..staging import path_exists


def read_documents(spark: SparkSession, path: str, collected_at: str | None = None) -> DataFrame:
    """Documents as JSON lines.  Blank lines are skipped, a malformed line fails the job.

    An absent ``metadata`` becomes an empty struct, an absent ``collected_at`` the given time.
    """
    docs = spark.read.schema(DOCUMENT).option("mode", "FAILFAST").json(path)
    empty = F.from_json(F.lit("{}"), METADATA)
    now = F.lit(collected_at) if collected_at else utc_now()
    return docs.withColumns(
        {"metadata": F.coalesce("metadata", empty), "collected_at": F.coalesce("collected_at", now)}
    )


def utc_now():
    """Current time as an ISO string in UTC."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def read_documents_if_present(spark: SparkSession, path: str) -> DataFrame:
    """Documents of an earlier run, or an empty table if there was none."""
    if path_exists(spark, path):
        return read_documents(spark, path)
    return spark.createDataFrame([], DOCUMENT)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QA_PAIR).option("mode", "FAILFAST").json(path)


def read_training_rows(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Training rows; a malformed line fails the job.

    Without a schema one is inferred, which reads all rows once more.
    """
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_validation_rows(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Validation rows, only if a path was given and exists."""
    if path and path_exists(spark, path):
        return read_training_rows(spark, path)
    return None
