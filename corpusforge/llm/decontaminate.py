"""Benchmark decontamination: a broadcast hash set of test windows scanned over every document's words.

A window is ``size`` consecutive words of a benchmark item; an item of fewer words, but not none, is one
window.  Every document window of a length that occurs among the items is hashed and looked up in the
broadcast table of item windows; a hash hit is verified word by word.  Only verified hits and one line per
document leave the scan, so nothing of a text is shuffled.

Defined cases: a null or wordless text has no words and no hit; an item without words has no window; an item
without id marks words but is not listed; repeated items count once per id; repeated rows each get their row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_ROWS, NON_ALNUM, fold_ascii, split_words, stage

WINDOW = 10
#: At most this many item windows are broadcast at once; more are taken in blocks, each a scan of its own.
BROADCAST_WINDOWS = 1_000_000


def _window_hash(words: Column, start: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, start + F.lit(k)) for k in range(size)])


def _n_windows(words: Column, size: int) -> Column:
    return F.greatest(F.size(words) - F.lit(size - 1), F.lit(0))


def _hashes(words: Column, size: int) -> Column:
    """The hash of every window of ``size`` words, in order; bare numbers, as there is one for each word of a text."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: _window_hash(words, i, size))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows of (item_id, text): hash, phrase, item_id."""
    words = items.select("item_id", split_words(fold_ascii(F.col("text")), NON_ALNUM).alias("words")).where("size(words) > 0")
    short = F.size("words") < size
    starts = F.when(short, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size("words") - size))
    phrases = words.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.slice("words", F.col("start") + 1, F.lit(size)).alias("window")
    )
    by_length = [F.when(F.size("window") == n, _window_hash(F.col("window"), F.lit(0), n)) for n in range(1, size + 1)]
    return phrases.select(
        F.coalesce(*by_length).alias("hash"),
        F.size("window").alias("length"),
        F.array_join("window", " ").alias("phrase"),
        "item_id",
    ).distinct()


def find_hits(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document row of (doc_id, text, ...): doc_id, text_hash, copies, n_words, spans, item_ids.

    ``spans`` are the sorted (start, length) of verified hits in words, ``item_ids`` the sorted ids as text.
    ``copies`` counts rows of the same id and text, which share one row here.
    """
    windows = item_windows(items, size)
    # One lookup row per hash and phrase; the items of a phrase are few (they are rows of the benchmark).
    lookup = windows.groupBy("hash", "length", "phrase").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    counts = {row["length"]: row["count"] for row in lookup.groupBy("length").count().collect()}  # at most ``size`` rows
    blocks = max(1, -(-sum(counts.values()) // BROADCAST_WINDOWS))
    mark = lookup.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("hash"), F.lit(0).alias("length"), F.lit(None).cast("string").alias("phrase"),
        F.array().cast("array<string>").alias("ids"),
    )
    lookup = lookup.unionByName(mark)

    words = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        split_words(fold_ascii(F.col("text")), NON_ALNUM).alias("words"),
    )
    # The first element stands for the document itself and always finds the row ``mark``.
    own = F.array(F.lit(0).cast("long"))
    lengths = sorted(counts)
    scanned = words.withColumn("windows", F.concat(own, *[_hashes(F.col("words"), n) for n in lengths]))
    # Never empty; the outer form keeps the optimizer from computing ``windows`` a second time in a filter below.
    each = scanned.select("doc_id", "text_hash", "words", F.posexplode_outer("windows").alias("place", "h"))

    def look_up(block: DataFrame) -> DataFrame:
        return each.join(F.broadcast(block), each.h == block.hash)

    met = reduce(DataFrame.unionByName, [look_up(lookup.where(F.pmod("hash", F.lit(blocks)) == b)) for b in range(blocks)])
    # Windows stand by length, then by start, behind the first element.
    before = F.lit(1)
    start = F.lit(-1)
    for n in lengths:
        start = F.when(F.col("length") == n, F.col("place") - before).otherwise(start)
        before = before + _n_windows(F.col("words"), n)
    met = met.select("doc_id", "text_hash", "words", "phrase", "ids", "place", F.col("length").alias("n"), start.alias("start"))
    # Words hold no blank, so equal phrases are windows of one length.
    is_phrase = (F.col("start") >= 0) & (F.array_join(F.slice("words", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n")), " ") == F.col("phrase"))
    verified = met.where(F.when(F.col("n") == 0, F.col("place") == 0).otherwise((F.col("place") > 0) & is_phrase))
    return (
        verified.select(
            "doc_id", "text_hash", F.size("words").alias("n_words"), "ids", "n",
            F.when(F.col("n") > 0, F.struct("start", F.col("n").alias("length"))).alias("span"),
        )
        .groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count_if(F.col("n") == 0).alias("copies"),
            F.array_sort(F.collect_set("span")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids"),
        )
    )


def covered(spans: Column) -> Column:
    """Number of words inside any of the sorted spans."""
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))

    def step(state: Column, span: Column) -> Column:
        end = span.start + span.length
        new = F.greatest(F.lit(0), end - F.greatest(state.end, span.start))
        return F.struct(F.greatest(state.end, end).alias("end"), (state.words + new).alias("words"))

    return F.aggregate(spans, empty, step, lambda state: state.words)


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, spans, item_ids, contaminated."""
    hits = find_hits(docs, items, size).withColumn("n_hit", covered(F.col("spans")))
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return hits.select(
        "doc_id", "n_words", "n_hit", "spans", "item_ids", (F.col("n_hit") > 0).alias("contaminated"), repeated.alias("_copy")
    ).drop("_copy")


def remove_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans`` and the gaps behind them.

    The text is as written, so capitals are letters here, unlike in the folded text that was scanned.
    """
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    lead = F.regexp_extract(text, f"^{gap}*", 0)
    pieces = F.regexp_extract_all(text, F.lit(f"([^{gap[1:-1]}]+{gap}*)"), F.lit(1))

    def inside(i: Column) -> Column:
        return F.exists(spans, lambda s: (s.start <= i) & (i < s.start + s.length))

    kept = F.filter(F.transform(pieces, lambda p, i: F.when(~inside(i), p)), lambda p: p.isNotNull())
    return F.concat(lead, F.array_join(kept, ""))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, action: str = "documents") -> DataFrame:
    """``docs`` without what they share with ``items``, all their columns kept.

    ``documents`` removes every document with a hit; ``spans`` keeps it and removes the words of its hits.
    """
    if action not in ("documents", "spans"):
        raise ValueError(f"unknown action: {action}")
    found = find_hits(docs, items, size).where("size(spans) > 0").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans")
    )
    if action == "documents":
        found = stage(found.drop("_spans"), "contaminated")
        # Few documents are contaminated, as a rule: then they go to all tasks and no text is shuffled.
        few = found.count() <= BROADCAST_ROWS
        on = [docs.doc_id.eqNullSafe(found["_id"]), F.xxhash64(docs.text) == found["_hash"]]
        return docs.join(F.broadcast(found) if few else found, on, "left_anti")
    on = [docs.doc_id.eqNullSafe(found["_id"]), F.xxhash64(docs.text) == found["_hash"]]
    joined = docs.join(found, on, "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(remove_spans(F.col("text"), F.col("_spans")))
    changed = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return joined.withColumns(changed).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``contamination``."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )
