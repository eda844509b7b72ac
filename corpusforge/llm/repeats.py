"""Suffix-array removal of repeated byte strings.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts elsewhere, in the same or another text.
Which strings can be equal is found by anchors: of the ``GRAM``-byte grams of a string, the one of least hash.
Equal strings have equal anchors at equal places, and a text has one anchor in about LENGTH / 2 bytes.

1. Anchors are counted; a bitmap of fixed size marks those that occur more than once.
2. Around each marked anchor the bytes of the strings it stands for are sent to the task of the anchor's hash
   (equal ones of a batch once, with their places).  Every string is in exactly one such piece.
3. A task parses its pieces into phrases between anchors of a finer kind and builds one suffix array over the
   phrase symbols by linear grouping; neighbouring suffixes whose common prefix is long enough are candidates,
   and the strings that start before them are compared by their hashes.
4. The places found are joined to their texts, which are cut and hashed.

An anchor of more than ``CROWD`` places is spread over several tasks; what a task of such an anchor finds only
once, or keeps of what it found, is matched between the tasks by one aggregation of string hashes.  So no group of any size
lands in one task, and nothing is dropped.  The bitmap saves work only: with more anchors than it can tell
apart, more pieces are sent, the result is the same.

What is counted is told by a rule: ``BYTES``, as above, or ``WORDS``, where a text is the row of its words' 64-bit hashes
and a passage is ``PASSAGE`` of them, whatever their bytes, blanks and outer punctuation; words are cut with the blanks behind them.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` have no string; rows repeated in all columns are
separate texts (each repeats the other); an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from typing import Iterator, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batches, shielded, stage, unshielded
from .hashing import bare_word_hashes, mix, powers, prefix_hashes, window_hashes, word_starts
from .suffixes import common_prefixes, suffix_array

LENGTH, GRAM = 400, 64
FINE_WINDOW, FINE_GRAM = 64, 16
#: Words of the shortest passage of the word rule: over 50.
PASSAGE = 51
#: Places of an anchor in one task at most; more are spread.
CROWD = 2_000
#: Cells of the bitmap of repeated anchors, whatever the input.
CELLS = 1 << 24
#: Bytes of text handled together, and of one stretch of a longer text.
BLOCK = 1_200_000
#: Texts in an Arrow batch.
TEXT_ROWS = 2_000
_PLACE_BITS = np.uint64(24)


class Rule(NamedTuple):
    """The units that texts are compared by, and how many make a string, a gram and a block."""

    length: int
    gram: int
    fine_window: int = FINE_WINDOW
    fine_gram: int = FINE_GRAM
    block: int = BLOCK
    words: bool = False

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u8" if self.words else "u1")

    def units(self, texts) -> list[np.ndarray]:
        encoded = [(text or "").encode() for text in texts]
        if self.words:
            return [bare_word_hashes(data) for data in encoded]
        return [np.frombuffer(data, dtype=np.uint8) for data in encoded]

    def at(self, data: bytes) -> np.ndarray | None:
        """Byte at which each unit of a text begins, and the text's end; None where units are bytes."""
        return np.r_[word_starts(np.frombuffer(data, dtype=np.uint8))[0], len(data)] if self.words else None


BYTES = Rule(LENGTH, GRAM)
# A word stands for eight bytes in all sizes, so that a passage holds as many anchors as a string of bytes.
WORDS = Rule(PASSAGE, GRAM // 8, FINE_WINDOW // 8, FINE_GRAM // 8, BLOCK // 8, True)


def least_in_windows(hashes: np.ndarray, window: int) -> np.ndarray:
    """Position of the leftmost least hash of every window, by block-wise running minima."""
    mask = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    keys = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    count = len(keys) - window + 1
    size = -(-len(keys) // window) * window
    padded = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, window)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(backward[:count], forward[window - 1 : window - 1 + count]) & mask).astype(np.int64)


def stretches(texts: list[np.ndarray], rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of text: data, and per stretch its text's index, its begin in the block and its offset in the text."""
    held, size = [], 0
    for at, data in enumerate(texts):
        for offset in range(0, max(0, len(data) - rule.length + 1), rule.block):
            piece = data[offset : offset + rule.block + rule.length - 1]
            if held and size + len(piece) > rule.block:
                yield _block(held)
                held, size = [], 0
            held.append((at, offset, piece))
            size += len(piece)
    if held:
        yield _block(held)


def _block(held):
    sizes = np.array([len(piece) for _, _, piece in held], dtype=np.int64)
    data = np.concatenate([piece for _, _, piece in held])
    return data, np.array([at for at, _, _ in held]), np.r_[0, np.cumsum(sizes)], np.array([offset for _, offset, _ in held])


def anchored(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """(first string start, number of starts, anchor hash, stretch) of every anchor of a block."""
    sums = prefix_hashes(data)
    grams = window_hashes(sums, np.arange(len(data) - gram + 1), gram)
    anchor = least_in_windows(grams, length - gram + 1)
    stretch = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(anchor)]
    valid = np.arange(len(anchor)) + length <= bounds[stretch + 1]
    change = np.r_[True, (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1]) | (stretch[1:] != stretch[:-1])]
    first = np.nonzero(change)[0]
    count = np.diff(np.r_[first, len(anchor)])
    good = valid[first]
    first, count = first[good], count[good]
    return first, count, grams[anchor[first]], stretch[first]


def _repeated_anchors(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Per cell of the bitmap 0 for anchors seen once, else 1 plus how many times their places double ``CROWD``."""
    parts = 1 << max(6, (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    width = CELLS // parts

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, _, bounds, _ in stretches(rule.units(batch["text"]), rule):
                value, count = np.unique(anchored(data, bounds, rule.length, rule.gram)[2], return_counts=True)
                part = ((value & np.uint64(CELLS - 1)) // np.uint64(width)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                rows = [(p, value[order[a:b]].tobytes(), count[order[a:b]].astype("<u4").tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                yield pd.DataFrame(rows, columns=["part", "anchors", "counts"])

    def often(group: pd.DataFrame) -> pd.DataFrame:
        value, where = np.unique(np.frombuffer(b"".join(group["anchors"]), "<u8"), return_inverse=True)
        count = np.bincount(where, np.frombuffer(b"".join(group["counts"]), "<u4"))
        more = count > 1
        cell = ((value[more] & np.uint64(CELLS - 1)) % np.uint64(width)).astype(np.int64)
        level = np.zeros(width, dtype=np.uint8)
        np.maximum.at(level, cell, 1 + np.ceil(np.log2(np.maximum(1, count[more] / CROWD))).astype(np.uint8))
        return pd.DataFrame({"part": [group["part"].iloc[0]], "levels": [zlib.compress(level.tobytes(), 1)]})

    chunks = docs.select("text").mapInPandas(seen, "part int, anchors binary, counts binary")
    levels = np.zeros(CELLS, dtype=np.uint8)
    for row in chunks.groupBy("part").applyInPandas(often, "part int, levels binary").collect():  # CELLS bytes in all, whatever the input
        levels[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zlib.decompress(row["levels"]), np.uint8)
    return levels


PIECE = "bucket int, anchor long, salt int, crowded boolean, piece binary, places binary"
FOUND = "doc_id long, text_hash long, start long, stop long, string long, once boolean"
_PLACE = np.dtype([("doc", "<i8"), ("known", "?"), ("text", "<i8"), ("start", "<i8")])


def _pieces(docs: DataFrame, rule: Rule) -> DataFrame:
    """The units of all strings of each repeated anchor, with the places where they stand."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(_repeated_anchors(docs, rule))
    width = rule.dtype.itemsize
    buckets = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = batch["doc_id"].notna().to_numpy()
            ids = batch["doc_id"].fillna("0").astype("int64").to_numpy()
            hashes = batch["text_hash"].to_numpy(dtype=np.int64)
            for data, owner, bounds, offsets in stretches(rule.units(batch["text"]), rule):
                first, count, anchor, stretch = anchored(data, bounds, rule.length, rule.gram)
                level = levels.value[(anchor & np.uint64(CELLS - 1)).astype(np.int64)]
                used = np.nonzero(level)[0]
                raw = data.tobytes()
                at = owner[stretch]
                start = first - bounds[stretch] + offsets[stretch]
                salt = (mix(hashes.astype(np.uint64) ^ ids.astype(np.uint64))[at] % (np.uint64(1) << np.maximum(level, 1).astype(np.uint64) - np.uint64(1))).astype(np.int64)
                held: dict[tuple, list] = {}
                for i in used.tolist():
                    piece = raw[first[i] * width : (first[i] + count[i] + rule.length - 1) * width]
                    held.setdefault((int(anchor[i]), int(salt[i]), int(level[i]), piece), []).append((ids[at[i]], known[at[i]], hashes[at[i]], start[i]))
                keys = list(held)
                bucket = (mix(np.array([k[0] for k in keys], dtype=np.uint64) + np.array([k[1] for k in keys], dtype=np.uint64)) % np.uint64(buckets)).astype(np.int32)
                yield pd.DataFrame(
                    {
                        "bucket": bucket,
                        "anchor": np.array([k[0] for k in keys], dtype=np.uint64).view(np.int64),
                        "salt": np.array([k[1] for k in keys], dtype=np.int32),
                        "crowded": [k[2] > 1 for k in keys],
                        "piece": [k[3] for k in keys],
                        "places": [np.array(v, dtype=_PLACE).tobytes() for v in held.values()],
                    }
                )

    return docs.select(F.col("doc_id").cast("string"), "text", F.xxhash64("text").alias("text_hash")).mapInPandas(cut, PIECE)


def repeated_starts(pieces: list[bytes], times: np.ndarray, rule: Rule) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each piece, which of its strings occur more than once among all pieces, and the strings' hashes.

    ``times`` counts the places of each piece.  Candidates come from one suffix array over phrase symbols: two equal
    strings share the phrases between the fine anchors that neither's surroundings can move.
    """
    length, fine_window, fine_gram = rule.length, rule.fine_window, rule.fine_gram
    data = np.frombuffer(b"".join(pieces), dtype=rule.dtype)
    sizes = np.array([len(p) // rule.dtype.itemsize for p in pieces], dtype=np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    sums = prefix_hashes(data)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    grams = window_hashes(sums, np.arange(len(data) - fine_gram + 1), fine_gram)
    fine = least_in_windows(grams, fine_window)
    inside = np.arange(len(fine)) + fine_window + fine_gram - 1 <= bounds[owner[: len(fine)] + 1]
    edges = np.unique(fine[inside])
    mine = owner[edges]
    # A phrase reaches to the next edge of its piece; the last one of a piece is its end mark.
    last = np.r_[mine[1:] != mine[:-1], True]
    reach = np.where(last, bounds[mine + 1], np.r_[edges[1:], 0])
    _, down = powers(len(sums))
    phrase = mix((sums[reach] - sums[edges]) * down[edges]) ^ (reach - edges).astype(np.uint64)
    symbol = np.unique(phrase, return_inverse=True)[1] + 2
    symbol[last] = 1
    symbols = symbol.tolist()
    order = suffix_array(symbols)
    shared = np.array(common_prefixes(symbols, order, 1), dtype=np.int64)
    order = np.array(order, dtype=np.int64)
    begin = edges[order]
    common = edges[np.minimum(order + shared, len(edges) - 1)] - begin
    # Two strings that are equal share all phrases from the first edge that is safe on the left to the last on the right.
    enough = common >= length - 2 * (fine_window - 1) - 2 * (fine_window + fine_gram - 1) + fine_gram
    member = np.zeros(len(edges), dtype=bool)
    member[order[enough]] = True
    member[order[:-1][enough[1:]]] = True
    # Strings that an edge stands for: it is the first edge at least fine_window - 1 units after their start.
    before = np.where(np.r_[True, mine[1:] != mine[:-1]], bounds[mine] - 1, np.r_[0, edges[:-1]] - (fine_window - 1))
    low = np.maximum(before + 1, bounds[mine])
    high = np.minimum(edges - (fine_window - 1), bounds[mine + 1] - length)
    candidate = np.zeros(len(data) + 1, dtype=np.int64)
    some = member & (low <= high)
    np.add.at(candidate, low[some], 1)
    np.add.at(candidate, high[some] + 1, -1)
    is_start = np.arange(len(data)) + length <= bounds[owner + 1]
    strings = np.nonzero(is_start)[0]
    hashes = window_hashes(sums, strings, length)
    of = owner[strings]
    repeated = times[of] > 1
    open_ = np.nonzero((np.cumsum(candidate)[:-1] > 0)[strings])[0]
    value, where = np.unique(hashes[open_], return_inverse=True)
    repeated[open_] |= np.bincount(where, times[of[open_]], minlength=len(value))[where] > 1
    cuts = np.searchsorted(of, np.arange(1, len(pieces)))
    return np.split(repeated, cuts), np.split(hashes, cuts)


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return list(zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist()))


def find_starts(docs: DataFrame, rule: Rule = BYTES) -> DataFrame:
    """doc_id, text_hash, start, stop: runs of starts of repeated strings in the texts of (doc_id, text)."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        # Equal pieces of different batches are one piece of more places; anchors met once are left out.
        held: dict[tuple, list] = {}
        for anchor, salt, crowded, piece, places in group[["anchor", "salt", "crowded", "piece", "places"]].itertuples(index=False, name=None):
            held.setdefault((anchor, salt, crowded, bytes(piece)), []).append(places)
        places = [np.frombuffer(b"".join(v), dtype=_PLACE) for v in held.values()]
        met: dict[tuple, int] = {}
        for (anchor, salt, crowded, _), where in zip(held, places):
            met[anchor, salt] = met.get((anchor, salt), 0) + len(where)
        chosen = [(key, where) for key, where in zip(held, places) if met[key[:2]] > 1 or key[2]]
        chosen.sort(key=lambda x: x[0][:2])
        at = 0
        while at < len(chosen):  # anchors together until a block is full, but an anchor never split
            end, size = at, 0
            while end < len(chosen) and (size < rule.block or chosen[end][0][:2] == chosen[end - 1][0][:2]):
                size += len(chosen[end][0][3]) // rule.dtype.itemsize
                end += 1
            part, at = chosen[at:end], end
            times = np.array([len(where) for _, where in part])
            repeated, hashes = repeated_starts([key[3] for key, _ in part], times, rule)
            told: set[int] = set()
            for (key, where), flags, strings in zip(part, repeated, hashes):
                runs = _runs(flags)
                for doc, known, text, start in where.tolist():
                    rows += [(doc if known else None, text, start + a, start + b, None, False) for a, b in runs]
                    if key[2]:
                        rows += [(doc if known else None, text, start + k, start + k + 1, int(strings[k].view(np.int64)), True) for k in np.nonzero(~flags)[0].tolist()]
                if key[2]:
                    fresh = set(strings[flags].view(np.int64).tolist()) - told
                    told |= fresh
                    rows += [(None, None, None, None, s, False) for s in fresh]
        # Column by column: a frame of rows would pass whole numbers beside nulls through floats.
        columns = list(zip(*rows)) if rows else [()] * 6
        whole = {name: pd.array(list(c), dtype="Int64") for name, c in zip(("doc_id", "text_hash", "start", "stop", "string"), columns)}
        return pd.DataFrame(whole | {"once": pd.array(list(columns[5]), dtype="bool")})

    with arrow_batches(docs.sparkSession, TEXT_ROWS):
        found = stage(_pieces(docs, rule).groupBy("bucket").applyInPandas(search, FOUND), "repeated-starts")
    sure = found.where("string is null").select("doc_id", "text_hash", "start", "stop")
    between = found.where("string is not null")
    again = between.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    more = between.where("once").join(again, "string", "left_semi").select("doc_id", "text_hash", "start", "stop")
    return sure.unionByName(more)


def removed_spans(docs: DataFrame, rule: Rule = BYTES) -> DataFrame:
    """_id, _hash, runs: sorted (start, stop) of removed units of each text that has some; runs may overlap."""
    starts = find_starts(docs, rule).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    return starts.agg(F.array_sort(F.collect_set(F.struct("start", (F.col("stop") + rule.length - 1).alias("stop")))).alias("runs"))


def cut(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    return cut_by(docs, Rule(length, gram))


def cut_by(docs: DataFrame, rule: Rule) -> DataFrame:
    """``cut`` by any rule; columns of ``docs`` named like a result come back as ``doc_<name>``."""
    docs, hidden = shielded(docs, ("doc_id", "text"))
    done = _cut_texts(docs, rule, "binary")
    whole = F.coalesce("text", F.lit("")).cast("binary")
    n_bytes = F.octet_length(whole).cast("long").alias("n_bytes")
    counts = [F.coalesce(F.col(f"_r.{c}"), F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")]
    return unshielded(done.select(*docs.columns, F.coalesce("_r.kept", whole).alias("kept"), n_bytes, *counts), hidden)


def _cut_texts(docs: DataFrame, rule: Rule, kind: str) -> DataFrame:
    """``docs`` (doc_id, text and others) with ``_r``: kept, n_removed and n_spans of a text that loses units, else nulls.

    Only texts that lose units go to Python, and once; ``kind`` tells whether what is left comes back as ``binary`` or,
    without the characters that lost some of their bytes, as ``string``.
    """
    spans = removed_spans(docs, rule)
    on = docs.doc_id.eqNullSafe(spans["_id"]) & (F.xxhash64(docs.text) == spans["_hash"])
    met = docs.join(spans, on, "left").drop("_id", "_hash")

    @F.pandas_udf(f"kept {kind}, n_removed long, n_spans long")
    def remove(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, runs):
            if found is None:
                out.append((None, None, None))
                continue
            data = (text or "").encode()
            kept, at, spans = [], 0, 0
            begins = rule.at(data)
            for run in found:
                start, stop = run["start"], run["stop"]
                if begins is not None:
                    start, stop = int(begins[start]), int(begins[stop])
                if spans == 0 or start > at:
                    kept.append(data[at:start])
                    spans += 1
                at = max(at, stop)
            rest = b"".join([*kept, data[at:]])
            out.append((rest.decode("utf-8", "ignore") if kind == "string" else rest, len(data) - len(rest), spans))
        frame = pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"], dtype=object)
        return frame.astype({"n_removed": "Int64", "n_spans": "Int64"})

    lost = F.when(F.col("runs").isNotNull(), F.col("text"))
    return met.withColumn("_r", remove(lost, "runs")).drop("runs")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the remaining text in place of ``text``; characters that lost bytes go whole."""
    return _with_rest(docs, Rule(length, gram))


def without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the passages of ``PASSAGE`` words and more that stand elsewhere too."""
    return _with_rest(docs, WORDS)


def _with_rest(docs: DataFrame, rule: Rule) -> DataFrame:
    docs, hidden = shielded(docs, ("doc_id", "text", "n_chars"))
    done = _cut_texts(docs, rule, "string")
    changed = done.withColumn("text", F.when(F.col("_r.n_removed") > 0, F.col("_r.kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return unshielded(changed.select(*docs.columns), hidden)
