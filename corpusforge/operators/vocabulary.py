"""Tagging with a vocabulary that is a table.

A term of ``functions.concepts`` is a whole word or several words with a blank, a hyphen or nothing between them.  Every
spelling of it is a row of an inverted table, which is written and measured.  A table within the bounds of what is sent goes
to all tasks in packed arrays, and they read each text once for all spellings; nothing is shuffled.  Of a larger one some goes to the
tasks, and the documents' sequences of tokens (runs of word characters, and single other characters) that may be other
spellings are looked up by an equi-join.  Either way the work for a document grows with its length, not with the terms,
and the result is the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.concepts import WORD
from ..functions.packed import Spellings
from ..functions.terms import key_bit, named_terms, numbers_and_keys, whole_terms
from ..staging import stage
from . import joins
from .rows import keep_where

_OTHER = r"[^\p{L}\p{N}_]"
_TOKEN = rf"{WORD}++|{_OTHER}"
_FIRST_WORD = rf"^{WORD}"
_LAST_WORD = rf"{WORD}$"

#: Words of a term at most; every further one triples its spellings.
MAX_WORDS = 8
#: Bits of the bitmap of the spellings that are not sent to the tasks, whatever their number.
BITS = 1 << 26
#: A packed spelling takes about 60 bytes in a task, so that many times the rows and bytes of a broadcast are sent.
PACKED_ROWS, PACKED_BYTES = 8, 3


def tokens(lower_text: Column) -> Column:
    """Runs of word characters, and every other character alone; together they are the text."""
    return F.regexp_extract_all(lower_text, F.lit(_TOKEN), F.lit(0))


def spellings(terms: DataFrame) -> DataFrame:
    """``(key, size, first, last, position, term)``: the texts that stand for each term of ``(position, term)``.

    ``size`` is a spelling's number of tokens; ``first`` and ``last`` tell whether it begins and ends with a word.
    """
    words = F.split(F.lower("term"), " ")
    joined = F.aggregate(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))),
        F.slice(words, 1, 1),
        lambda made, word: F.flatten(
            F.transform(made, lambda text: F.array(F.concat(text, F.lit(" "), word), F.concat(text, F.lit("-"), word), F.concat(text, word)))
        ),
    )
    several = F.size(words) > 1
    keys = F.when(several, joined).otherwise(F.array(F.lower("term")))
    too_long = F.raise_error(F.concat(F.lit(f"more than {MAX_WORDS} words: "), F.col("term")))
    checked = terms.where(F.trim("term") != "").select("position", "term", F.when(F.size(words) <= MAX_WORDS, keys).otherwise(too_long.cast("array<string>")).alias("keys"))
    rows = checked.select("position", "term", F.explode(F.array_distinct("keys")).alias("key"))
    key = F.col("key")
    return rows.select("key", F.size(tokens(key)).alias("size"), key.rlike(_FIRST_WORD).alias("first"), key.rlike(_LAST_WORD).alias("last"), "position", "term")


def tag_with_table(docs: DataFrame, terms: DataFrame, key: str = "id", content: str = "content") -> DataFrame:
    """``(key, concepts)`` of the documents that hold a term, in vocabulary order.

    ``terms`` is a table ``(position, term)``; terms of one position are ordered by their text.  ``key`` identifies a document.
    """
    table = stage(spellings(terms), "spellings")
    found = docs.select(F.col(key).alias("_id"), F.lower(content).alias("_lower"))
    tagged = _read_once(found, table) if is_small(table) else _looked_up(found, table)
    return tagged.select(F.col("_id").alias(key), "concepts")


def is_small(table: DataFrame) -> bool:
    """May all spellings go to the tasks?"""
    return joins.fits(table, PACKED_ROWS * joins.BROADCAST_ROWS, PACKED_BYTES * joins.BROADCAST_BYTES)


def _read_once(found: DataFrame, table: DataFrame) -> DataFrame:
    sent = found.sparkSession.sparkContext.broadcast(_packed(table)[:2])
    tags = F.struct(whole_terms(F.col("_lower"), sent).alias("concepts"))
    return keep_where(found, ["_id"], tags, lambda item: F.size(item["concepts"]) > 0)


def _packed(table: DataFrame) -> tuple[Spellings, pa.Array, pa.Array]:
    """The spellings, with the places of their terms in the vocabulary as numbers, and the terms and positions by number."""
    rows = table.select("key", "position", "term").orderBy("position", "term").toArrow()
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for column in (rows["position"], rows["term"]):
        here, before = column.slice(1), column.slice(0, max(len(rows) - 1, 0))
        other = pc.fill_null(pc.not_equal(here, before), False)
        new[1:] |= pc.or_(other, pc.xor(pc.is_null(here), pc.is_null(before))).to_numpy()
    first = rows.select(["term", "position"]).filter(pa.array(new))
    keys = _whole(rows["key"])
    del rows, column, here, before
    return Spellings.of(keys, np.cumsum(new, dtype=np.int32) - 1), _whole(first["term"]), _whole(first["position"])


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _looked_up(found: DataFrame, table: DataFrame) -> DataFrame:
    """Spellings beyond the bounds of a broadcast: as many as fit go to all tasks, the others are met by an equi-join.

    Which ones go is all one for the result: those of terms of few words, then by vocabulary order, as a word stands in more texts than
    a sequence.  Of a text only sequences that may be other spellings are shuffled, by a bitmap of fixed size, and the numbers of its terms.
    """
    spark = found.sparkSession
    words = F.size(F.split("term", " "))
    order = F.struct(words.alias("words"), "position", "term", "key")
    brief = F.octet_length("key") + F.octet_length("term") + 16 <= joins.BROADCAST_BYTES // joins.BROADCAST_ROWS
    last = table.where(brief).select(order.alias("at")).orderBy("at").limit(joins.BROADCAST_ROWS).agg(F.max("at").alias("at")).first()["at"]
    if last:
        kinds = {name: table.schema[name].dataType for name in ("position", "term", "key")}
        bound = F.struct(F.lit(last["words"]).alias("words"), *[F.lit(last[name]).cast(kind).alias(name) for name, kind in kinds.items()])
        rest = stage(table.where(~brief | (order > bound)), "further-spellings")
        own_terms = table.where(brief & (order <= bound))
    else:
        rest, own_terms = table, table.limit(0)
    packed, terms, positions = _packed(own_terms)
    pairs = list(zip(positions.to_pylist(), terms.to_pylist()))
    send = spark.sparkContext.broadcast
    spellings_sent = send(packed)
    # At most four rows for every number of tokens that a term may have.
    kinds = sorted(map(tuple, rest.select("size", "first", "last").distinct().collect()))
    met = numbers_and_keys(F.col("_lower"), spellings_sent, send(_bitmap(rest)), kinds)
    seen = stage(found.select("_id", met.alias("met")).select("_id", "met.numbers", "met.keys").where("size(numbers) > 0 or size(keys) > 0"), "met-spellings")
    none = F.array().cast("array<int>")
    further = seen.select("_id", F.explode("keys").alias("key")).join(rest, "key").select("_id", none.alias("numbers"), F.struct("position", "term").alias("item"))
    own = seen.where("size(numbers) > 0").select("_id", "numbers", F.lit(None).cast(further.schema["item"].dataType).alias("item"))
    hits = own.unionByName(further).groupBy("_id").agg(
        F.array_distinct(F.flatten(F.collect_list("numbers"))).alias("numbers"), F.collect_set("item").alias("items")
    )
    return hits.select("_id", named_terms(F.col("numbers"), F.col("items"), send(pairs)).alias("concepts"))


def _bitmap(spelled: DataFrame) -> bytes:
    """The ``key_bit`` of every spelling in a bitmap of ``BITS``; its pieces come to the driver, of fixed size in all."""
    width = BITS >> 8
    at = key_bit(F.col("key"), BITS)
    word = spelled.select(F.shiftright(at, width.bit_length() - 1).cast("int").alias("part"), at.bitwiseAND(F.lit(width - 1)).cast("int").alias("at"))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(width, dtype=bool)
        flags[group["at"].to_numpy()] = True
        return pd.DataFrame({"part": [group["part"].iloc[0]], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    pieces = {row["part"]: row["bits"] for row in word.distinct().groupBy("part").applyInPandas(packed, "part int, bits binary").collect()}
    return b"".join(pieces.get(part, bytes(width // 8)) for part in range(1 << 8))
