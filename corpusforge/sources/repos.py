"""Repository files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import decode_base64
from ..rules import DomainRules
from ..schemas import REPO_FILE
from ..staging import stage


def read_repo_files(spark: SparkSession, path: str) -> DataFrame:
    """File table as JSON lines with base64 bodies."""
    return spark.read.schema(REPO_FILE).option("mode", "FAILFAST").json(path)


def read_repo_files_and_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The file table's good rows, and the lines that are none, so that one broken row does not stop the others.

    A reject is ``(repo, reason, line)``: lines that are not valid JSON of the table's types, and rows that do not name
    their repository and path.  A broken line's repository is what it tells of it, else null.  The lines are parsed
    once, into a written table that both results read.
    """
    lines = spark.read.schema(f"{REPO_FILE}, _line string").option("columnNameOfCorruptRecord", "_line").json(path)
    rows = stage(lines, "repo-lines")
    nameless = F.coalesce("repo", F.lit("")).eqNullSafe("") | F.coalesce("path", F.lit("")).eqNullSafe("")
    broken = F.col("_line").isNotNull()
    good = rows.where(~broken & ~nameless).drop("_line")
    told = F.nullif(F.regexp_extract("_line", r'"repo"\s*:\s*"([^"]*)"', 1), F.lit(""))
    line = F.coalesce("_line", F.to_json(F.struct(*good.columns)))
    reason = F.when(broken, F.lit("malformed")).otherwise(F.lit("no repository or path"))
    rejects = rows.where(broken | nameless).select(
        F.coalesce(told, F.nullif(F.col("repo"), F.lit(""))).alias("repo"), reason.alias("reason"), line.alias("line")
    )
    return good, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``(repo, reason, rejects)`` per repository and reason."""
    return rejects.groupBy("repo", "reason").agg(F.count(F.lit(1)).alias("rejects"))


def read_checkout(spark: SparkSession, folder: str, repo: str, base_url: str, rules: DomainRules) -> DataFrame:
    """Files of a checked-out repository ``owner/name`` under ``folder``.

    The suffix filter is applied while listing, so other files are never opened.
    """
    suffixes = ",".join(
        "".join(f"[{char}{char.upper()}]" if char.isalpha() else char for char in extension[1:])
        for extension in rules.kept_extensions
    )
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{{{suffixes}}}")
        .load(folder)
    )
    root = folder.rstrip("/")
    root = root if root.startswith("/") or ":" in root else f"/{root}"
    after_root = F.length(F.lit(root.split(":", 1)[-1].replace("//", "/", 1).rstrip("/"))) + 2
    plain = F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/")
    relative = F.substring(plain, after_root, F.length(plain))
    header = F.concat(F.lit("blob "), F.col("length").cast("string"))
    blob = F.concat(F.encode(header, "UTF-8"), F.unhex(F.lit("00")), F.col("content"))
    return files.select(
        F.lit(repo).alias("repo"),
        relative.alias("path"),
        F.regexp_extract(relative, r"([^/]+)$", 1).alias("name"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), relative).alias("html_url"),
        F.sha1(blob).alias("sha"),
        F.col("length").alias("size"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("content"),
    )


def with_content(files: DataFrame) -> DataFrame:
    """Decode ``content_b64`` unless the table already has ``content``."""
    if "content" in files.columns:
        return files
    return files.withColumn("content", decode_base64(F.col("content_b64"))).drop("content_b64")
