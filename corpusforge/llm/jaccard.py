"""Exact n-gram Jaccard join: size-banded tiles, bitmap signatures, sorted-array intersection.

Documents are sets of hashed word shingles.  Equal sets are one class from the start, so copies of any number
are one set.  Two sets of Jaccard ``PERCENT`` % or more share a shingle among the first n - ceil(n * PERCENT / 100) + 1
of either under any fixed order; here shingles seen often (a bounded bitmap) come last, so passages that many
documents share do not make tiles.  Candidates meet in tiles of one shingle and neighbouring size bands, are
pruned by sizes and by the parities of their signatures (differing bits bound the overlap from above), and are
then checked by intersecting their sorted arrays.

1. Every class is compared with two classes for each of its ``LEADS`` shingles of least hash: the one with the smallest
   share of uncommon shingles, which is the centre of a family of near copies, and one by chance.
2. Of the tiles whose classes are still in different components, as many likely pairs are checked as tie these together;
   members of pairs that this leaves out are noted.
3. Their pairs that are apart even then are compared in full; what is left is exact.

Components, not all pairs, are the result, so pairs inside a component need no check and no link is lost.
Nothing about all documents reaches the driver but the bitmaps, whose sizes are fixed.

A class is a number of its own, so ids only matter for the result.

Defined cases: a null or wordless text is an empty set, linked with nothing; fewer words than ``SIZE`` are one
shingle; rows of one doc_id and different texts are separate sets; rows without doc_id link like others, their
component is null if it holds no id at all; an empty table gives no rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batches, stage
from .components import connected
from .hashing import in_blocks, mix, shingle_sets

SIZE, PERCENT = 5, 80
LEADS = 4
#: Bits of a signature for each shingle, and the largest signature as a power of two.
PER_SHINGLE, MOST_BITS = 2, 15
#: Times common shingles are looked for.
ROUNDS = 3
#: A shingle in the leading part of more sets than this comes last in the order.
COMMON = 16
#: Bits of the two bitmaps, whatever the input: common shingles, and documents whose sets are checked.
BITS = 1 << 24
#: Rows of an Arrow batch: texts, and pairs with both arrays.
TEXT_ROWS, PAIR_ROWS = 2_000, 500
_U = np.dtype("<u8")


def lead_length(n, percent: int = PERCENT):
    """Shingles of a set of ``n`` of which a partner shares at least one."""
    return n - -(-n * percent // 100) + 1


def signature(tokens: np.ndarray) -> bytes:
    """Parities of a set: a bit says whether an odd number of shingles fall on it; larger sets get more bits, a power of two.

    What two sets share cancels out where their parities differ, however large the sets are.
    """
    bits = 1 << min(MOST_BITS, max(8, int(PER_SHINGLE * len(tokens) - 1).bit_length()))
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sig: bytes) -> list[int]:
    """A signature as four whole numbers, 256 bits."""
    bits = np.frombuffer(sig or bytes(32), np.uint8)
    return np.bitwise_xor.reduce(bits.reshape(-1, 32), axis=0).view("<i8").tolist()


def overlap_bound(a: bytes, b: bytes, size_a: int, size_b: int) -> int:
    """No two sets of these signatures and sizes share more: each differing bit stands for a shingle of one alone."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return (size_a + size_b - int(np.bitwise_count(x ^ y).sum())) // 2


def _sets(texts: list[str | None], size: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, encoded in in_blocks(texts):
        for k, tokens in enumerate(shingle_sets(encoded, size)):
            yield first + k, tokens


def _key(tokens: np.ndarray) -> bytes:
    """Identity of a set: two sums of differently scattered values."""
    other = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return np.array([tokens.sum(), other.sum()], dtype=_U).tobytes()


def in_order(tokens: np.ndarray, common: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The leading shingles of a set, common ones last, and how many of them are not common."""
    often = _has(common, (tokens & np.uint64(BITS - 1)).astype(np.int64))
    lead = np.concatenate([tokens[~often], tokens[often]])[: lead_length(len(tokens), percent) if len(tokens) else 0]
    return lead, min(len(lead), int((~often).sum()))


def _common_tokens(docs: DataFrame, size: int, percent: int, rounds: int = ROUNDS) -> np.ndarray:
    """Bitmap of shingles that lead more than ``COMMON`` rows; counts are of all rows, by the low 32 bits of a hash.

    When common shingles go last, others come up that may be as common: the rows this happens to are counted again.
    """
    bitmap = np.zeros(BITS // 8, dtype=np.uint8)
    for number in range(rounds):
        bitmap = bitmap | _leading_often(docs, size, percent, bitmap, number > 0)
    return bitmap


def _leading_often(docs: DataFrame, size: int, percent: int, bitmap: np.ndarray, changed: bool) -> np.ndarray:
    """Bitmap of shingles that lead often under the order of ``bitmap``; ``changed`` counts rows with another lead than by hash."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(bitmap)
    parts = 1 << max(6, (int(spark.conf.get("spark.sql.shuffle.partitions")) * 2 - 1).bit_length())
    width = BITS // parts

    def leads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for _, tokens in _sets(list(batch["text"]), size):
                lead, rare = in_order(tokens, sent.value, percent)
                if rare and not (changed and np.array_equal(lead, tokens[: len(lead)])):
                    found.append(lead[:rare])
            if found:
                token, count = np.unique(np.concatenate(found).astype("<u4"), return_counts=True)
                part = ((token & np.uint32(BITS - 1)) // np.uint32(width)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                rows = [(p, token[order[a:b]].tobytes(), count[order[a:b]].astype("<u4").tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                yield pd.DataFrame(rows, columns=["part", "tokens", "counts"])

    def count(group: pd.DataFrame) -> pd.DataFrame:
        tokens = np.frombuffer(b"".join(group["tokens"]), "<u4")
        counts = np.frombuffer(b"".join(group["counts"]), "<u4")
        token, where = np.unique(tokens, return_inverse=True)
        often = token[np.bincount(where, counts) > COMMON]
        bits = np.zeros(width, dtype=bool)
        bits[((often & np.uint32(BITS - 1)) % np.uint32(width)).astype(np.int64)] = True
        return pd.DataFrame({"part": [group["part"].iloc[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    chunks = docs.select("text").mapInPandas(leads, "part int, tokens binary, counts binary")
    bitmap = np.zeros((parts, width // 8), dtype=np.uint8)
    for row in chunks.groupBy("part").applyInPandas(count, "part int, bits binary").collect():  # BITS in all, whatever the input
        bitmap[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return bitmap.reshape(-1)


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def row_hash():
    """What tells rows of (doc_id, text) apart, beside their ids."""
    return F.xxhash64("doc_id", "text").alias("row_hash")


def profiles(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_hash, n, key, sig, lead (packed shingles in order), n_rare (how many of lead are not common), least (shingles of least hash), f0..f3 (sig folded)."""
    common = docs.sparkSession.sparkContext.broadcast(_common_tokens(docs, size, percent))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, tokens in _sets(list(batch["text"]), size):
                n = len(tokens)
                lead, rare = in_order(tokens, common.value, percent)
                sig = signature(tokens) if n else b""
                out.append((n, _key(tokens), sig, lead.astype(_U).tobytes(), rare, tokens[:LEADS].astype("<i8"), *folded(sig)))
            yield pd.DataFrame(out, columns=["n", "key", "sig", "lead", "n_rare", "least", "f0", "f1", "f2", "f3"]).assign(doc_id=batch["doc_id"], row_hash=batch["row_hash"])

    # Ids go as text: beside nulls pandas would make them floats.
    named = docs.select(F.col("doc_id").cast("string"), "text", row_hash())
    found = named.mapInPandas(rows, "n long, key binary, sig binary, lead binary, n_rare int, least array<long>, f0 long, f1 long, f2 long, f3 long, doc_id string, row_hash long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _bound_ok(n_a: int, sig_a: bytes, n_b: int, sig_b: bytes, percent: int) -> bool:
    most = overlap_bound(sig_a, sig_b, n_a, n_b)
    return 100 * most >= percent * (n_a + n_b - most)


def pruned(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link."""
    of = lambda name: sets.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sig").alias(f"sig_{name}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b")
    met = met.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [_bound_ok(*row, percent) for row in zip(batch["n_a"], batch["sig_a"], batch["n_b"], batch["sig_b"])]
            yield batch.loc[np.array(good, dtype=bool), ["a", "b"]]

    return met.select("a", "b", "n_a", "sig_a", "n_b", "sig_b").mapInPandas(keep, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes that are links, by intersecting their sorted arrays.

    The row that stands for a class is found again by its hash; a bitmap of fixed size keeps other rows from being hashed.
    """
    spark = docs.sparkSession
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(classes.join(wanted, "node", "left_semi").select("node", F.col("key").alias("_key"), F.col("rep_hash").alias("row_hash")), "wanted-classes")
    spot = F.pmod("row_hash", F.lit(BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(row_hash, {BITS}) & 31 as int))")
    words = wanted.select(F.shiftright(spot, 5).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bitmap = np.zeros(BITS // 32, dtype=np.uint32)
    found = words.toArrow()  # at most BITS / 32 rows, in one job
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    wanted_bits = spark.sparkContext.broadcast(bitmap)

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["row_hash"].to_numpy() % BITS
            # Equal rows of a batch are hashed once.
            batch = batch[(wanted_bits.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1].drop_duplicates("row_hash")
            found = [(tokens.astype(_U).tobytes(), _key(tokens)) for _, tokens in _sets(list(batch["text"]), size)]
            yield pd.DataFrame(found, columns=["tokens", "key"]).assign(row_hash=batch["row_hash"].array)

    sets = docs.select("text", row_hash()).mapInPandas(arrays, "tokens binary, key binary, row_hash long")
    sets = sets.join(wanted, "row_hash").where("key = _key").select("node", "tokens")
    sets = stage(sets, "checked-sets")
    if sets.count() > wanted.count():  # rows that are equal in id and text stand for one class
        sets = stage(sets.groupBy("node").agg(F.min("tokens").alias("tokens")), "checked-sets")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    hubs = sets.join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_semi")
    both = left.join(hubs.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for x, y in zip(batch["tokens_a"], batch["tokens_b"]):
                p, q = np.frombuffer(x, _U), np.frombuffer(y, _U)
                at = np.searchsorted(q, p)
                shared = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                good.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield batch.loc[np.array(good, dtype=bool), ["a", "b"]]

    with arrow_batches(spark, PAIR_ROWS):
        return stage(both.select("a", "b", "tokens_a", "tokens_b").mapInPandas(check, "a long, b long").distinct(), "links")


def exploded(sets: DataFrame, packed: str, begin: str, columns: tuple[str, ...]) -> DataFrame:
    """One row (token, place, ``columns``) for each packed shingle of a column from the place ``begin`` on."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [np.frombuffer(data, "<i8")[at:] for data, at in zip(batch["packed"], batch["begin"])]
            sizes = [len(t) for t in tokens]
            if sum(sizes):
                place = np.concatenate([np.arange(at, at + n) for at, n in zip(batch["begin"], sizes)])
                yield pd.DataFrame({"token": np.concatenate(tokens), "place": place} | {c: np.repeat(batch[c].to_numpy(), sizes) for c in columns})

    narrow = sets.select(F.col(packed).alias("packed"), F.expr(begin).alias("begin"), *columns)
    types = ", ".join(f"{c} {sets.schema[c].dataType.simpleString()}" for c in columns)
    return narrow.mapInPandas(rows, f"token long, place long, {types}")


def hub_pairs(sets: DataFrame) -> DataFrame:
    """Every class with two classes for each of its shingles of least hash."""
    rare = F.col("n_rare") / F.greatest(F.length("lead") / 8, F.lit(1))
    least = sets.select(F.explode("least").alias("token"), "doc_id", "n", rare.cast("double").alias("rare"))
    hubs = least.groupBy("token").agg(
        F.min_by("doc_id", F.struct("rare", "n", "doc_id")).alias("centre"),
        F.min_by("doc_id", F.struct(F.xxhash64("token", "doc_id"), "doc_id")).alias("chance"),
        F.count(F.lit(1)).alias("n_in"),
    )
    met = least.join(hubs.where("n_in > 1"), "token").select("doc_id", F.explode(F.array("centre", "chance")).alias("hub")).where("doc_id <> hub")
    return met.select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()


def _steps(token: np.ndarray, n: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbours at a distance of 1, 2, ... in tiles, sorted by token and size, until the sizes are too far apart."""
    at, step = np.arange(len(token) - 1), 1
    while len(at):
        at = at[at + step < len(token)]
        other = at + step
        near = (token[at] == token[other]) & (100 * n[at] >= percent * n[other])
        at = at[near]
        yield at, other[near]
        step += 1


def _shared(number: int, row: np.ndarray, token: np.ndarray, rank: np.ndarray, n: np.ndarray, comp: np.ndarray, ids: np.ndarray, percent: int) -> pd.DataFrame:
    """Of one bucket the shingles (places ``row`` of ``n``, ``comp`` and ``ids``) that sets of different components share."""
    order = np.lexsort((n[row], token))
    token, row, rank = token[order], row[order], rank[order]
    size, part = n[row], comp[row]
    left = size - rank.astype(np.int64)
    partner = np.zeros(len(token), dtype=bool)
    for at, other in _steps(token, size, percent):
        apart = (part[at] != part[other]) & ((100 + percent) * np.minimum(left[at], left[other]) >= percent * (size[at] + size[other]))
        partner[at[apart]] = partner[other[apart]] = True
    at = np.nonzero(partner)[0]
    at = at[np.argsort(row[at], kind="stable")]
    cuts = np.r_[0, np.nonzero(np.diff(row[at]))[0] + 1, len(at)] if len(at) else [0]
    out = [(number, ids[row[at[a]]], n[row[at[a]]], token[at[a:b]].tobytes(), rank[at[a:b]].tobytes()) for a, b in zip(cuts, cuts[1:])]
    return pd.DataFrame(out, columns=["bucket", "doc_id", "n", "tokens", "ranks"])


_MEMBERS = "bucket int, doc_id long, n long, tokens binary, ranks binary"


def tile_members(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """bucket, doc_id, n, tokens, ranks: the leading shingles that are not common and that a set shares with another.

    Tiles are packed per bucket, and no tile is wider than ``COMMON`` rows but for those that ``ROUNDS`` missed. What two sets share
    lies behind their first common shingle, so sets whose rest is too short there are no partners.
    """
    spark = sets.sparkSession
    buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [np.frombuffer(lead, _U)[:rare] for lead, rare in zip(batch["lead"], batch["n_rare"])]
            sizes = np.array([len(t) for t in tokens], dtype=np.int64)
            if not sizes.sum():
                continue
            flat = np.concatenate(tokens)
            row = np.repeat(np.arange(len(tokens)), sizes).astype("<u2")
            rank = (np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype("<u4")
            bucket = (mix(flat) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            held = {c: batch[c].to_numpy(dtype="<i8") for c in ("doc_id", "n")}
            out = []
            for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    used, local = np.unique(row[order[a:b]], return_inverse=True)
                    out.append((number, flat[order[a:b]].tobytes(), local.astype("<u2").tobytes(), rank[order[a:b]].tobytes(), *[held[c][used].tobytes() for c in held]))
            yield pd.DataFrame(out, columns=["bucket", "tokens", "rows", "ranks", "doc_id", "n"])

    def sharing(group: pd.DataFrame) -> pd.DataFrame:
        tokens = np.frombuffer(b"".join(group["tokens"]), _U)
        base, rows = 0, []
        for r, ids in zip(group["rows"], group["doc_id"]):
            rows.append(np.frombuffer(r, "<u2").astype(np.int64) + base)
            base += len(ids) // 8
        row = np.concatenate(rows)
        ids, n = (np.frombuffer(b"".join(group[c]), "<i8") for c in ("doc_id", "n"))
        rank = np.frombuffer(b"".join(group["ranks"]), "<u4")
        return _shared(group["bucket"].iloc[0], row, tokens, rank, n, ids, ids, percent)

    packed = sets.select("doc_id", "n", "lead", "n_rare").mapInPandas(
        pack, "bucket int, tokens binary, rows binary, ranks binary, doc_id binary, n binary"
    )
    return packed.groupBy("bucket").applyInPandas(sharing, _MEMBERS)


def _unpacked(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle and rank of everything packed in a bucket's members."""
    row = np.repeat(np.arange(len(group)), [len(t) // 8 for t in group["tokens"]])
    return row, np.frombuffer(b"".join(group["tokens"]), _U), np.frombuffer(b"".join(group["ranks"]), "<u4")


def still_apart(members: DataFrame, roots: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The members, and their shingles, that share one with a set of another component; with ``comp``."""

    def apart(group: pd.DataFrame) -> pd.DataFrame:
        ids, n, comp = (group[c].to_numpy(dtype=np.int64) for c in ("doc_id", "n", "comp"))
        return _shared(group["bucket"].iloc[0], *_unpacked(group), n, comp, ids, percent)

    return with_components(members, roots).groupBy("bucket").applyInPandas(apart, _MEMBERS)


def tile_pairs(members: DataFrame, sets: DataFrame, roots: DataFrame, spanning: bool, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of different components in a tile of ``members`` whose sizes, places and signatures allow a link.

    ``spanning`` keeps of each bucket only as many as tie its components together, the likeliest first.  The members of the
    others come as (doc_id, null, bucket): what is apart once the ties are checked is among these (``left_out``).
    """
    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        row, token, rank = _unpacked(group)
        ids, n, comp = (group[c].to_numpy(dtype=np.int64) for c in ("doc_id", "n", "comp"))
        folds = group[["f0", "f1", "f2", "f3"]].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.lexsort((n[row], token))
        token, row, left = token[order], row[order], (n[row] - rank.astype(np.int64))[order]
        found = [np.zeros(0, np.int64)]
        for at, other in _steps(token, n[row], percent):
            x, y = row[at], row[other]
            both = n[x] + n[y]
            apart = (comp[x] != comp[y]) & ((100 + percent) * np.minimum(left[at], left[other]) >= percent * both)
            x, y, both = x[apart], y[apart], both[apart]
            odd = np.bitwise_count(folds[x] ^ folds[y]).sum(axis=1, dtype=np.int64)
            near = (100 + percent) * (both - odd) >= 2 * percent * both
            found.append(np.minimum(x, y)[near] * len(group) + np.maximum(x, y)[near])
        x, y = np.divmod(np.unique(np.concatenate(found)), len(group))
        if spanning:
            odd = np.bitwise_count(folds[x] ^ folds[y]).sum(axis=1, dtype=np.int64)
            nearest = np.lexsort((ids[y], ids[x], odd / (n[x] + n[y])))
            x, y = x[nearest], y[nearest]
        sig, sizes, parts, out = list(group["sig"]), n.tolist(), comp.tolist(), []
        above: dict[int, int] = {}
        passed: set[int] = set()

        def root(part: int) -> int:
            while (up := above.get(part, part)) != part:
                above[part] = part = above.get(up, up)
            return part

        for i, j in zip(x.tolist(), y.tolist()):
            if spanning and root(parts[i]) == root(parts[j]):
                passed.update((i, j))
                continue
            if not _bound_ok(sizes[i], sig[i], sizes[j], sig[j], percent):
                continue
            if spanning:
                above[root(parts[i])] = root(parts[j])
            out.append((i, j))
        both = ids[np.array(out, dtype=np.int64).reshape(-1, 2)]
        rest = ids[np.array(sorted(passed), dtype=np.int64)]
        a, b = np.r_[both.min(axis=1), rest], np.r_[both.max(axis=1), np.zeros_like(rest)]
        tie = np.arange(len(a)) < len(both)
        bucket = np.full(len(a), group["bucket"].iloc[0], dtype=np.int64)
        return pd.DataFrame({"a": a, "b": pd.arrays.IntegerArray(b, ~tie), "bucket": pd.arrays.IntegerArray(bucket, tie)})

    held = sets.select("doc_id", "sig", "f0", "f1", "f2", "f3")
    return with_components(members, roots).join(held, "doc_id").groupBy("bucket").applyInPandas(pairs, "a long, b long, bucket int").distinct()


def left_out(members: DataFrame, ties: DataFrame) -> DataFrame:
    """The members of pairs that were no ties of their bucket, as ``tile_pairs`` noted them."""
    noted = ties.where("b is null").select("bucket", F.col("a").alias("doc_id"))
    return members.join(noted, ["bucket", "doc_id"], "left_semi")


def with_components(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """``sets`` with ``comp``, the component of each; a set without links is one of its own."""
    joined = sets.join(roots.select(F.col("id").alias("doc_id"), "root"), "doc_id", "left")
    return joined.withColumn("comp", F.coalesce("root", "doc_id")).drop("root")


def common_pairs(sets: DataFrame, roots: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of different components that share a common leading shingle: tiles of a shingle and a size band.

    Of each shingle only classes outside its largest component are compared with the others.
    """
    folds = ("f0", "f1", "f2", "f3")
    leads = with_components(exploded(sets, "lead", "n_rare", ("doc_id", "n", *folds)), roots)
    shares = leads.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = shares.groupBy("token").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
    mixed = stage(leads.join(main.where("comps > 1"), "token"), "common-leads")
    band = F.floor(F.log("n") / float(np.log(100 / percent))).cast("int")
    carried = ("doc_id", "n", "comp", "place", *folds)
    few = mixed.where("comp <> main").select("token", F.explode(F.array(band - 1, band, band + 1)).alias("band"), *[F.col(c).alias(f"{c}_a") for c in carried])
    all_ = mixed.select("token", band.alias("band"), "main", *[F.col(c).alias(f"{c}_b") for c in carried])
    both = F.col("n_a") + F.col("n_b")
    # Equal bits bound the overlap, and so does what follows the first common shingle in either set.
    bits = sum((F.bit_count(F.col(f"{f}_a").bitwiseXOR(F.col(f"{f}_b"))) for f in folds), F.lit(0))
    after = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    met = few.join(all_, ["token", "band"]).where(
        (F.col("comp_a") != F.col("comp_b"))
        & ((F.col("comp_b") == F.col("main")) | (F.col("doc_id_a") < F.col("doc_id_b")))
        & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        & ((100 + percent) * (both - bits) >= 2 * percent * both)
        & ((100 + percent) * after >= percent * both)
    )
    return met.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()


def _tied(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Edges of the components so far and of further links."""
    return roots.select(F.col("id").alias("a"), F.col("root").alias("b")).where("a <> b").unionByName(links)


def _linked(roots: DataFrame, pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """``roots`` after the links among the staged ``pairs``."""
    if pairs.isEmpty():
        return roots
    links = verified(pairs, docs, classes, size, percent)
    return roots if links.isEmpty() else stage(connected(_tied(roots, links)), "roots")


def join_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, row_hash, n_shingles, component_id, and group.

    ``group`` numbers the components, also those without any id; null for empty sets.
    """
    with arrow_batches(docs.sparkSession, TEXT_ROWS):
        return _join_classes(docs, size, percent)


def _join_classes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    every = stage(profiles(docs, size, percent), "profiles")
    # A class is stood for by a row of its smallest id, if it has one.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_hash")).alias("first")
    classes = every.where("n > 0").groupBy("key").agg(first)
    classes = classes.select("key", F.col("first.doc_id").alias("first_id"), F.col("first.row_hash").alias("rep_hash"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "set-classes")
    own = classes.select(F.col("key").alias("_key"), "rep_hash", "node")
    # Rows that are equal in id and text go by the keys of the join, so the wide rows move once.
    sets = every.dropDuplicates(["key", "row_hash"]).join(own, (F.col("key") == F.col("_key")) & (F.col("row_hash") == F.col("rep_hash")))
    sets = stage(sets.drop("_key", "key", "rep_hash", "row_hash", "doc_id").withColumnRenamed("node", "doc_id"), "sets")

    hubs = stage(pruned(hub_pairs(sets), sets, percent), "hub-pairs")
    roots = stage(connected(verified(hubs, docs, classes, size, percent)), "roots")
    members = stage(still_apart(stage(tile_members(sets, percent), "tile-members"), roots, percent), "members-apart")
    tiled = stage(sets.select("doc_id", "sig", "f0", "f1", "f2", "f3").join(members.select("doc_id").distinct(), "doc_id", "left_semi"), "tiled-sets")
    ties = stage(tile_pairs(members, tiled, roots, True, percent), "tile-ties")
    roots = _linked(roots, ties.where("b is not null").select("a", "b"), docs, classes, size, percent)
    more = tile_pairs(left_out(members, ties), tiled, roots, False, percent).select("a", "b")
    often = stage(common_pairs(sets, roots, percent), "common-pairs")
    if not often.isEmpty():
        more = more.unionByName(pruned(often, sets, percent)).distinct()
    roots = _linked(roots, stage(more, "tile-pairs"), docs, classes, size, percent)

    of_class = classes.join(roots.select(F.col("id").alias("node"), "root"), "node", "left").withColumn("group", F.coalesce("root", "node"))
    smallest = of_class.where("root is not null").groupBy("group").agg(F.min("first_id").alias("smallest"))
    of_class = of_class.join(smallest, "group", "left").select(
        F.col("key").alias("_k"), "group", F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("smallest")).alias("component")
    )
    rows = every.select("doc_id", "row_hash", "n", "key")
    joined = rows.join(of_class, (rows.key == of_class["_k"]) & (rows.n > 0), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", "row_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), "group")
