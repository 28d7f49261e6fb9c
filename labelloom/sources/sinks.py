"""Writers for the labelled table, its statistics and the run's reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXPORT_COLUMNS = [
    "id", "content", "label", "cluster_id", "confidence", "quality_score",
    "modality", "iteration", "anomaly_flag", "duplicate_flag",
]
FORMATS = ["csv", "json", "parquet"]


def write_csv(labeled: DataFrame, path: str) -> str:
    """Ten columns as CSV; vectors, if any, go to a parquet table beside it."""
    target = f"{path}/dataset.csv"
    labeled.select(*EXPORT_COLUMNS).write.mode("overwrite").csv(
        target, header=True, quoteAll=True, escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    if "v" in labeled.columns:
        labeled.select("id", F.col("v").alias("embedding")).write.mode("overwrite").parquet(
            f"{path}/embeddings"
        )
    return target


def write_json(labeled: DataFrame, path: str) -> str:
    """One JSON object per line, with vector and metadata where present."""
    target = f"{path}/dataset.json"
    extra = [F.col("v").alias("embedding")] if "v" in labeled.columns else []
    extra += ["metadata"] if "metadata" in labeled.columns else []
    labeled.select(*EXPORT_COLUMNS, *extra).write.mode("overwrite").json(target, ignoreNullFields=True)
    return target


def write_parquet(labeled: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Columnar table with the vector and without metadata."""
    target = f"{path}/dataset.parquet"
    extra = [F.col("v").alias("embedding")] if "v" in labeled.columns else []
    writer = labeled.select(*EXPORT_COLUMNS, *extra).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)
    return target


def export(labeled: DataFrame, format: str, path: str, configuration: dict[str, str] | None = None) -> str:
    """Write the dataset in one format and its statistics as ``metadata.json``."""
    from labelloom.operators.metrics import dataset_stats, label_distribution

    writers = {"csv": write_csv, "json": write_json, "parquet": write_parquet}
    if format not in writers:
        raise ValueError(f"unsupported export format: {format}")
    target = writers[format](labeled, path)
    stats = dataset_stats(labeled)
    for key, value in (configuration or {}).items():
        stats = stats.withColumn(f"config_{key}", F.lit(str(value)))
    stats.withColumn("written_at", F.current_timestamp().cast("string")).write.mode("overwrite").json(
        f"{path}/metadata.json"
    )
    label_distribution(labeled).write.mode("overwrite").json(f"{path}/label_distribution.json")
    return target


def write_report(report: DataFrame, path: str, name: str) -> str:
    """Provenance, taxonomy or drift history as JSON lines."""
    target = f"{path}/{name}.json"
    report.write.mode("overwrite").json(target)
    return target
