"""Registered queries of the subpackage: name to ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..staging import new_path
from . import decontaminate, density, jaccard, licences, mixing, outliers, perspectives, repeats, secret_links, token_align, toxicity, turn_repair, warc
from .common import stage, table


def op1_quality_rules(spark, folder):
    return outliers.judge(table(spark, folder, "documents"))


def op2_warc(spark, folder):
    """Every page written to archives and read back from them."""
    path = new_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    records = warc.read_archives(spark, path, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid", "error")


def op3_jaccard_join(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.join_classes(docs).select("doc_id", "n_shingles", "component_id")


def op4_source_mix(spark, folder):
    sized = mixing.with_size(table(spark, folder, "documents").select("doc_id", "source", "text")).drop("text")
    return mixing.mix(stage(sized, "sizes")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op5_licences(spark, folder):
    found = licences.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_parts", F.array_join("identifiers", ",").alias("identifiers"), F.array_join("licences", ",").alias("licences"),
        F.size("matches").cast("long").alias("n_matches"),
    )


def op6_perspectives(spark, folder):
    return perspectives.rotate(table(spark, folder, "conversations"))


def op7_repeats(spark, folder):
    done = repeats.cut(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark, folder):
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    scored = toxicity.detect(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op9_decontaminate(spark, folder):
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, items))


def op10_main_text(spark, folder):
    return density.extract(table(spark, folder, "pages"))


def op11_turn_repair(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.report(turn_repair.damaged(turns))


def op12_token_align(spark, folder):
    return token_align.aligned_counts(table(spark, folder, "documents").select("doc_id", "text"))


def op13_secret_links(spark, folder):
    return secret_links.digest(secret_links.scan(table(spark, folder, "documents").select("doc_id", "text")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_warc, op3_jaccard_join, op4_source_mix, op5_licences, op6_perspectives, op7_repeats, op8_toxicity, op9_decontaminate, op10_main_text,
        op11_turn_repair, op12_token_align, op13_secret_links,
    )
}
