"""Alignment of two tokenizers' tokens, by ``merge_asof`` per batch.

A byte-level vocabulary (A) encodes space + text, a piece vocabulary (B) encodes the text and adds the space itself; both
then tile the same bytes.  Per block of documents every token start of one side finds the token of the other side that
covers it, which is the last one that starts at or before it: an as-of merge keyed by document.  The union of both
directions is all pairs of overlapping tokens; byte offsets at which tokens of both sides end cut them into groups.

1. One map pass encodes and aligns; per document it keeps the counts, the groups' hash and its distinct linked id pairs
   with how often each is linked, packed.  This narrow table is staged, so nothing is encoded twice.
2. Documents are counted per id pair: tasks add up their own counts first, then one aggregation of (pair, count).
3. Pairs in many documents, at most ``HOT`` of them by their counted number, go to every task as sorted arrays; documents
   add up their links' counts there.  Links of rarer pairs, if there are any, meet their counts in a shuffled join, in
   which no pair is frequent; their sums are added to the documents'.

A space between two signs that are no blanks begins a token on both sides: A's pattern takes it with the word behind it,
and no piece of B holds its mark for a space behind another sign (both are checked when a vocabulary is loaded).  So text is
encoded word by word, each distinct word of a task once, and a giant text is handled in pieces of ``PIECE`` characters.

Defined cases: null and empty texts, and texts that B does not give back byte for byte (they hold its mark for a space),
have no tokens: zeros and ''; special tokens' strings are plain text; rows repeated in all columns are documents of
their own and all count; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from functools import lru_cache
from typing import Iterator, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batches, stage

FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Id pairs that are sent to every task at most.
HOT = 1_000_000
#: Characters of text aligned together, and of one piece of a longer text.
BLOCK = PIECE = 1_000_000
#: Words whose tokens a task remembers.
KNOWN_WORDS = 300_000
#: Rows of an Arrow batch, and id pairs a task adds up before it hands them on.
TEXT_ROWS, PAIRS = 1_000, 500_000

#: A space that begins a token on both sides.
WORD_END = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
SPACE_MARK = "▁"
ALIGNED = "doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def byte_letters() -> dict[str, int]:
    """Letter by which byte-level vocabularies write each byte: printable Latin-1 signs stand for themselves, the rest follows from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(0x100 + k): byte for k, byte in enumerate(others)}


class Vocabularies:
    """Both tokenizers from their files' contents, with the bytes of every token."""

    def __init__(self, data_a: bytes, data_b: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        import sentencepiece
        from tokenizers import Tokenizer

        settings = json.loads(data_a)
        splitter = settings["pre_tokenizer"] or {}
        if settings["normalizer"] or splitter.get("type") != "ByteLevel" or not splitter.get("use_regex", True) or splitter.get("add_prefix_space"):
            raise ValueError("the first vocabulary must be byte-level, without normalisation or prefix")
        self.a = Tokenizer.from_str(data_a.decode())
        self.a.encode_special_tokens = True
        letters = byte_letters()
        ids = settings["model"]["vocab"]
        self.bytes_a: list[bytes] = [b""] * (max(ids.values()) + 1)
        special = {token["content"] for token in settings["added_tokens"]}
        for entry, number in ids.items():
            if entry not in special:
                self.bytes_a[number] = bytes(letters[letter] for letter in entry)

        self.b = sentencepiece.SentencePieceProcessor(model_proto=data_b)
        pieces = [self.b.id_to_piece(number) for number in range(self.b.get_piece_size())]
        if any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in pieces) or not self.b.id_to_piece(self.b.encode("a")[0]).startswith(SPACE_MARK):
            raise ValueError("pieces of the second vocabulary must begin at spaces")
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(SPACE_MARK, " ").encode() for number, piece in enumerate(pieces)
        ]
        self.size_a, self.size_b = (np.array([len(data) for data in table], dtype=np.int64) for table in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        """Drop the remembered words."""
        self.slots: dict[str, int] = {}
        self.ids, self.begins, self.good = (array("i"), array("i")), (array("q", [0]), array("q", [0])), bytearray()

    def learn(self, words: list[str]) -> None:
        """Encode words that are not remembered yet."""
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            of_a = [found.ids for found in self.a.encode_batch([" " + word for word in part], add_special_tokens=False)]
            of_b = self.b.encode(part, num_threads=1)
            for word, a, b in zip(part, of_a, of_b):
                self.slots[word] = len(self.good)
                data = (" " + word).encode()
                self.good.append(b"".join([self.bytes_a[i] for i in a]) == data == b"".join([self.bytes_b[i] for i in b]))
                for side, found in enumerate((a, b)):
                    self.ids[side].extend(found)
                    self.begins[side].append(len(self.ids[side]))

    def encode(self, texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """((ids, number of each text's tokens) of A and of B, which texts both give back)."""
        if len(self.slots) > KNOWN_WORDS or max(map(len, self.ids)) > 16 * KNOWN_WORDS:
            self.forget()
        split = [WORD_END.split(text) for text in texts]
        counts = np.array([len(words) for words in split], dtype=np.int64)
        slots = self.slots
        self.learn(list(dict.fromkeys(word for words in split for word in words if word not in slots)))
        slot = np.fromiter((slots[word] for words in split for word in words), dtype=np.int64, count=counts.sum())
        first = np.cumsum(counts) - counts
        sides = []
        for ids, begins in zip(self.ids, self.begins):
            flat, begin = np.frombuffer(ids, dtype=np.int32), np.frombuffer(begins, dtype=np.int64)
            size = begin[slot + 1] - begin[slot]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[slot], size)
            sides.append((flat[place], np.add.reduceat(size, first)))
        good = np.logical_and.reduceat(np.frombuffer(bytes(self.good), dtype=np.uint8)[slot] == 1, first)
        return sides, good


@lru_cache(maxsize=2)
def vocabularies(data_a: bytes, data_b: bytes) -> Vocabularies:
    return Vocabularies(data_a, data_b)


class Side(NamedTuple):
    """Tokens of one tokenizer: ids, documents, and the bytes they reach from and to, which never overlap between documents."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def side(ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> Side:
    end = np.cumsum(sizes[ids])
    return Side(ids, np.repeat(np.arange(len(counts)), counts), end - sizes[ids], end)


def links(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of all overlapping pairs, each pair once."""

    def covering(of: Side, other: Side) -> np.ndarray:
        left = pd.DataFrame({"doc": of.doc, "start": of.start})
        right = pd.DataFrame({"doc": other.doc, "start": other.start, "token": np.arange(len(other.start))})
        return pd.merge_asof(left, right, on="start", by="doc", direction="backward")["token"].to_numpy()

    over_a, over_b = covering(a, b), covering(b, a)
    # Tokens that start together find each other from both sides.
    fresh = a.start[over_b] != b.start
    return np.r_[np.arange(len(a.ids)), over_b[fresh]], np.r_[over_a, np.nonzero(fresh)[0]]


def group_text(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all documents as bytes, the end of each document's part in it, and each document's number of groups."""
    cuts = np.intersect1d(a.end, b.end, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, a.end), np.searchsorted(cuts, b.end)
    in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    # Tokens of A stand before those of B in their group.
    order = np.empty(len(a.ids) + len(b.ids), dtype=np.int64)
    order[: len(a.ids)] = np.arange(len(a.ids)) + (np.cumsum(in_b) - in_b)[group_a]
    order[len(a.ids) :] = np.arange(len(b.ids)) + np.cumsum(in_a)[group_b]
    last_a, last_b = np.r_[group_a[1:] != group_a[:-1], True], np.r_[group_b[1:] != group_b[:-1], True]
    ids, mark = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.uint8)
    ids[order] = np.r_[a.ids, b.ids]
    mark[order] = np.r_[np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))]
    digits = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, len(str(max(int(ids.max()), 1)))))
    stop = np.cumsum(digits + 1)
    text = np.zeros(stop[-1], dtype=np.uint8)
    text[stop - 1] = mark
    rest, at = ids.copy(), stop - 2
    for place in range(int(digits.max())):
        has = digits > place
        text[at[has] - place] = rest[has] % 10 + ord("0")
        rest //= 10
    docs = int(a.doc[-1]) + 1
    return text, stop[np.cumsum(np.bincount(a.doc, minlength=docs) + np.bincount(b.doc, minlength=docs)) - 1], np.bincount(a.doc[last_a], minlength=docs)


def pieces(texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
    """Blocks of (index, piece) of about ``BLOCK`` characters; longer texts are cut where both sides begin a token."""
    held, size = [], 0
    for index, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            cut = WORD_END.search(text, at + PIECE) if len(text) - at > PIECE else None
            piece = text[at : cut.start()] if cut else text[at:]
            at = cut.end() if cut else len(text)
            if held and size + len(piece) > BLOCK:
                yield held
                held, size = [], 0
            held.append((index, piece))
            size += len(piece)
    if held:
        yield held


class Document:
    """What is known of a text, piece by piece."""

    def __init__(self) -> None:
        self.good, self.counts, self.digest, self.begun = True, np.zeros(4, dtype=np.int64), hashlib.sha256(), False
        self.pairs, self.times = np.zeros(0, dtype="<i8"), np.zeros(0, dtype="<i8")
        self.groups: list[str] = []

    def add(self, counts: tuple[int, ...], text: bytes, pairs: np.ndarray, times: np.ndarray, keep: bool) -> None:
        self.counts += counts
        self.digest.update((b";" if self.begun else b"") + text)
        self.begun = True
        if keep:
            self.groups.append(text.decode())
        if len(self.pairs):
            both, where = np.unique(np.r_[self.pairs, pairs], return_inverse=True)
            pairs, times = both, np.bincount(where, np.r_[self.times, times]).astype("<i8")
        self.pairs, self.times = pairs, times

    def row(self) -> tuple:
        if not self.good or not self.begun:
            return 0, 0, 0, 0, "", b"", b"", ""
        return *self.counts.tolist(), self.digest.hexdigest(), self.pairs.astype("<i8").tobytes(), self.times.astype("<i4").tobytes(), ";".join(self.groups)


def align_texts(texts: list[str | None], both: Vocabularies, keep_groups: bool = False) -> list[tuple]:
    """Per text: tokens of A and B, groups, links, the groups' hash, its packed distinct pairs and their times, the groups if wanted."""
    found = [Document() for _ in texts]
    for block in pieces(texts):
        (of_a, of_b), good = both.encode([piece for _, piece in block])
        for (index, _), is_good in zip(block, good.tolist()):
            found[index].good &= is_good
        keep = np.nonzero(good)[0]
        if not len(keep):
            continue
        number = np.cumsum(good) - 1
        masks = [np.repeat(good, counts) for _, counts in (of_a, of_b)]
        a = side(of_a[0][masks[0]], of_a[1][keep], both.size_a)
        b = side(of_b[0][masks[1]], of_b[1][keep], both.size_b)
        link_a, link_b = links(a, b)
        text, stops, groups = group_text(a, b)
        raw = text.tobytes()
        width = np.int64(len(both.bytes_b))
        key = a.doc[link_a] * (np.int64(len(both.bytes_a)) * width) + a.ids[link_a] * width + b.ids[link_b]
        key, times = np.unique(key, return_counts=True)
        doc, pair = np.divmod(key, np.int64(len(both.bytes_a)) * width)
        bounds = np.searchsorted(doc, np.arange(len(keep) + 1))
        linked = np.bincount(a.doc[link_a], minlength=len(keep))
        for at in keep.tolist():
            k = int(number[at])
            low, high = bounds[k], bounds[k + 1]
            counts = (of_a[1][at], of_b[1][at], groups[k], linked[k])
            begin = stops[k - 1] if k else 0
            found[block[at][0]].add(counts, raw[begin : stops[k] - 1], pair[low:high], times[low:high], keep_groups)
    return [one.row() for one in found]


def align(docs: DataFrame, file_a: str = f"{FOLDER}/{FILE_A}", file_b: str = f"{FOLDER}/{FILE_B}", groups: bool = False) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the packed ``pairs`` and ``times``.

    A pair is ``id of A * pieces of B + id of B``.  ``groups`` adds the text of the groups.  The files are read by the
    driver and sent to the tasks.
    """
    data = [open(path, "rb").read() for path in (file_a, file_b)]
    sent = docs.sparkSession.sparkContext.broadcast(data)
    names = [part.split()[0] for part in ALIGNED.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = vocabularies(*sent.value)
        for batch in batches:
            done = align_texts(list(batch["text"]), both, groups)
            frame = pd.DataFrame([row[:7] for row in done], columns=names[1:]).assign(doc_id=batch["doc_id"])
            yield frame.assign(groups=[row[7] for row in done]) if groups else frame

    # Ids go as text: beside nulls pandas would make them floats.
    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(rows, ALIGNED + (", groups string" if groups else ""))
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs): documents in which each id pair is linked."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch["pairs"]), "<i8")
            pair, where = np.unique(np.r_[held[0], pairs], return_inverse=True)
            held = pair, np.bincount(where, np.r_[held[1], np.ones(len(pairs), np.int64)], minlength=len(pair)).astype(np.int64)
            if len(pair) > PAIRS:
                yield pd.DataFrame({"pair": held[0], "docs": held[1]})
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield pd.DataFrame({"pair": held[0], "docs": held[1]})

    return aligned.select("pairs").mapInPandas(count, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


def _hot_from(pairs: DataFrame, hot: int) -> int:
    """Least power of two such that at most ``hot`` pairs are in that many documents or more; 1 if all pairs are few."""
    rows = pairs.groupBy(F.length(F.bin("docs")).alias("bits")).count().collect()  # at most 63 rows
    room, least = hot, 1 + max((row["bits"] for row in rows), default=0)
    for row in sorted(rows, key=lambda row: -row["bits"]):
        if row["count"] > room:
            return 1 << least - 1
        room, least = room - row["count"], row["bits"]
    return 1


def score(aligned: DataFrame, pieces_b: int, hot: int = HOT) -> DataFrame:
    """``aligned`` (staged) with ``n_best`` and ``count_sum`` in place of the packed pairs."""
    spark = aligned.sparkSession
    counted = stage(pair_counts(aligned), "pair-counts")
    # One row per id of A, so at most its vocabulary.
    of_a = F.floor(F.col("pair") / F.lit(pieces_b))
    most = counted.groupBy(of_a.alias("_a")).agg(F.max("docs").alias("_most"))
    rated = counted.join(F.broadcast(most), of_a == most["_a"]).select("pair", "docs", (F.col("docs") == F.col("_most")).alias("best"))
    least = _hot_from(counted, hot)
    frequent = rated.where(F.col("docs") >= least).toPandas().sort_values("pair")  # at most ``hot`` rows
    known = spark.sparkContext.broadcast(tuple(frequent[name].to_numpy() for name in ("pair", "docs", "best")))
    kept = [name for name in aligned.columns if name not in ("pairs", "times")]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, docs, best = known.value
        for batch in batches:
            out = []
            for packed, packed_times in zip(batch["pairs"], batch["times"]):
                mine, times = np.frombuffer(packed, "<i8"), np.frombuffer(packed_times, "<i4").astype(np.int64)
                at = np.searchsorted(pair, mine)
                met = pair[np.minimum(at, len(pair) - 1)] == mine if len(pair) else np.zeros(len(mine), dtype=bool)
                at, rare = at[met], ~met
                out.append((int(times[met][best[at].astype(bool)].sum()), int((times[met] * docs[at]).sum()), mine[rare].tobytes(), times[rare].astype("<i4").tobytes()))
            names = ["n_best", "count_sum", "pairs", "times"]
            yield pd.concat([batch[kept], pd.DataFrame(out, columns=names, index=batch.index)], axis=1)

    types = ", ".join(f"{name} {'string' if name == 'doc_id' else aligned.schema[name].dataType.simpleString()}" for name in kept)
    texts = aligned.withColumn("doc_id", F.col("doc_id").cast("string"))
    summed = texts.mapInPandas(add_up, f"{types}, n_best long, count_sum long, pairs binary, times binary")
    summed = summed.withColumn("doc_id", F.col("doc_id").cast("long"))
    if least == 1:
        return summed.drop("pairs", "times")

    rows = stage(summed.withColumn("row", F.monotonically_increasing_id()), "summed")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["pairs"].map(len).to_numpy() // 8
            yield pd.DataFrame({
                "row": np.repeat(batch["row"].to_numpy(), sizes),
                "pair": np.frombuffer(b"".join(batch["pairs"]), "<i8"),
                "times": np.frombuffer(b"".join(batch["times"]), "<i4").astype(np.int64),
            })

    rare = rows.where(F.length("pairs") > 0).select("row", "pairs", "times").mapInPandas(unpack, "row long, pair long, times long")
    met = rare.join(rated.where(F.col("docs") < least).hint("shuffle_merge"), "pair")
    more = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_n"), F.sum(F.col("times") * F.col("docs")).alias("_s"))
    added = {"n_best": F.col("n_best") + F.coalesce("_n", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_s", F.lit(0))}
    return rows.join(more, "row", "left").withColumns(added).select(*kept, "n_best", "count_sum")


def aligned_counts(docs: DataFrame, file_a: str = f"{FOLDER}/{FILE_A}", file_b: str = f"{FOLDER}/{FILE_B}", hot: int = HOT) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    import sentencepiece

    with arrow_batches(docs.sparkSession, TEXT_ROWS):
        aligned = stage(align(docs, file_a, file_b), "aligned")
    return score(aligned, sentencepiece.SentencePieceProcessor(model_file=file_b).get_piece_size(), hot)
