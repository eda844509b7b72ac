"""Training files per format, their manifest and a two-split columnar data set."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.formats import DEFAULT_FORMATS, FORMATS, json_row
from ..operators.split import Boundary, in_shuffled_order, in_train, split_boundary, with_shuffle_key
from ..staging import drop_path, move_path, path_exists, stage
from .jsonl import write_jsonl

logger = logging.getLogger(__name__)


def ordered_pairs(pairs: DataFrame, seed: str = "0", partitions: int | None = None) -> DataFrame:
    """Pairs in shuffled order: the one global shuffle that all formats share."""
    return in_shuffled_order(with_shuffle_key(pairs, seed), partitions)


def shuffled_pairs(pairs: DataFrame, seed: str = "0", partitions: int | None = None) -> DataFrame:
    """Stored pairs in shuffled order, ready to be split."""
    return stage(ordered_pairs(pairs, seed, partitions), "pairs")


def write_formats(
    shuffled: DataFrame,
    output_dir: str,
    system_prompt: str,
    formats=None,
    template: str = "llama3",
    fraction: float = 0.9,
) -> dict:
    """Write ``<format>/train`` and ``<format>/validation`` and the manifest.

    ``shuffled`` comes from ``shuffled_pairs``.  One job writes the rows of all formats and splits: every pair is
    rendered once per format and goes to the folder of its format and split, in shuffled order.  It is map-only, as
    the split is a comparison with one boundary key.  Returns the paths and counts per format.
    """
    root = output_dir.rstrip("/")
    names = []
    for name in DEFAULT_FORMATS if formats is None else formats:
        if name not in FORMATS:
            logger.warning("unknown format: %s", name)
        elif name not in names:
            names.append(name)
    boundary = split_boundary(shuffled, fraction)
    counts = {"train": boundary.train, "validation": boundary.total - boundary.train}
    outputs = {
        name: {**{split: f"{root}/{name}/{split}" for split in counts}, "train_count": counts["train"], "val_count": counts["validation"]}
        for name in names
    }
    if names:
        _write_rendered(shuffled, boundary, root, names, system_prompt)
    info = manifest(shuffled.sparkSession, boundary, outputs, template)
    write_jsonl(info.coalesce(1), f"{root}/dataset_info")
    return outputs


def rendered_rows(shuffled: DataFrame, boundary: Boundary, names: list[str], system_prompt: str) -> DataFrame:
    """``(value, format, split)``: the JSON line of every pair in every format, in the order of their files."""
    split = F.when(in_train(boundary), F.lit("train")).otherwise(F.lit("validation"))
    lines = F.array(*[F.struct(json_row(name, system_prompt).alias("value"), F.lit(name).alias("format")) for name in names])
    rows = shuffled.select(F.inline(lines), split.alias("split"), "shuffle_key", "copy")
    # A task's files are written one after the other; within each of them the shuffled order stays.
    return rows.sortWithinPartitions("format", "split", "shuffle_key", "copy")


def _write_rendered(shuffled: DataFrame, boundary: Boundary, root: str, names: list[str], system_prompt: str) -> None:
    spark = shuffled.sparkSession
    written = f"{root}/_rendered"
    rows = rendered_rows(shuffled, boundary, names, system_prompt)
    rows.select("value", "format", "split").write.mode("overwrite").partitionBy("format", "split").text(written)
    for name in names:
        for split in ("train", "validation"):
            part = f"{written}/format={name}/split={split}"
            if path_exists(spark, part):
                move_path(spark, part, f"{root}/{name}/{split}")
            else:  # no pair is in this split
                spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{root}/{name}/{split}")
    drop_path(spark, written)


def manifest(spark: SparkSession, boundary: Boundary, outputs: dict, template: str) -> DataFrame:
    """One row: counts, per-format paths and counts, template name."""
    per_format = "struct<train:string,validation:string,train_count:bigint,val_count:bigint>"
    names = ",".join(f"`{name}`:{per_format}" for name in outputs)
    row = (boundary.total, boundary.train, boundary.total - boundary.train, outputs, template)
    return spark.createDataFrame(
        [row],
        "total_examples bigint, train_examples bigint, validation_examples bigint, "
        f"formats struct<{names}>, template string",
    )


def write_dataset(shuffled: DataFrame, output_dir: str, system_prompt: str, fraction: float = 0.9) -> str:
    """Parquet data set of ``trl`` rows, partitioned by ``split``."""
    boundary = split_boundary(shuffled, fraction)
    split = F.when(in_train(boundary), F.lit("train")).otherwise(F.lit("validation"))
    path = f"{output_dir.rstrip('/')}/dataset"
    rows = shuffled.select(*FORMATS["trl"](system_prompt), split.alias("split"))
    rows.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def write_run_stats(spark: SparkSession, stats: dict, outputs: dict, path: str) -> None:
    """One JSON row with the counters, times and output paths of a run."""
    per_format = "struct<train:string,validation:string,train_count:bigint,val_count:bigint>"
    names = ",".join(f"`{name}`:{per_format}" for name in outputs)
    row = spark.createDataFrame(
        [(stats, outputs)],
        "stats struct<docs_collected:bigint,code_collected:bigint,qa_pairs_generated:bigint,files_rejected:bigint,model_errors:bigint,"
        f"start_time:string,end_time:string>, output_paths struct<{names}>",
    )
    write_jsonl(row.coalesce(1), path)
