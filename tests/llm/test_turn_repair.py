"""Conversation repair against an exhaustive search over edits, and its defined cases."""

import hashlib
import itertools
import random
import zlib

from pyspark.sql import functions as F

from corpusforge.llm import turn_repair

BLANKS = " \t\n\v\f\r"
FINAL = ("", "ua", "sua")
COLUMNS = "conv_id long, turn long, role string, text string"


def harmed(rows):
    """The rows of one conversation after damage, in order."""
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        harm = zlib.crc32(key.encode()) % 20
        if harm == 1:
            text = ""
        if harm == 2:
            text = "".join(c for c in text if c not in ".!?")
        if harm == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def well_formed(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return not initials or (body != "" and body == "ua" * (len(body) // 2))


def brute(rows):
    """All edits with up to one insert before each row and two at the end."""
    rows = harmed(rows)
    faults, seen = [], set()
    for _, role, text in rows:
        core = text.strip(BLANKS)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    best = None
    choices = []
    for fault in faults:
        stay = () if fault in ("blank", "duplicate") else (("K", None), ("R", "user"), ("R", "assistant"))
        choices.append([(insert, edit) for insert in (None, "user", "assistant") for edit in (("D", None), *stay)])
    tail = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for picked in itertools.product(*choices, tail):
        cost, audit, lines, initials = 0, "", [], ""
        for (insert, (edit, to)), (_, role, text), fault in zip(picked, rows, faults):
            if insert:
                cost, audit, initials = cost + 5, audit + "I", initials + insert[0]
                lines.append(f"{insert}:")
            audit += edit
            cost += {"D": 2, "K": 0, "R": 1}[edit]
            if edit != "D":
                cost += 5 if fault == "truncated" else 0
                initials += (to or role)[:1] or "?"
                lines.append(f"{to or role}:{text}")
        for insert in picked[-1]:
            cost, audit, initials = cost + 5, audit + "I", initials + insert[0]
            lines.append(f"{insert}:")
        if well_formed(initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, "\n".join(lines))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    legal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = faults.count
    return (gaps, count("blank"), count("duplicate"), count("truncated"), legal, *best[:2], hashlib.sha256(best[2].encode()).hexdigest())


def tables(seed, conversations, most):
    rng = random.Random(seed)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "", None, "u", "supervisor"]
    texts = ["Yes.", "no", "Why?", " \n", "", None, "Stop! \t", "...", "É.\u0085", "end.\x00"]
    rows = []
    for conv_id in [None, *range(conversations)]:
        for _ in range(rng.randrange(1, most + 1)):
            rows.append((conv_id, rng.choice([None, *range(6), -3]), rng.choice(roles), rng.choice(texts)))
    return rows


def by_conversation(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return groups


def test_edits_equal_exhaustive_search(spark):
    rows = tables(5, 300, 4)
    turns = spark.createDataFrame(rows, COLUMNS).withColumn("gone", F.lit("clash")).withColumn("fault", F.lit("clash")).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.report(turn_repair.damaged(turns)).collect()}
    want = {conv_id: brute(group) for conv_id, group in by_conversation(rows).items()}
    assert got == want


def test_spilled_conversations_give_the_same(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "user", "system"]), rng.choice(["a.", "b", f"c{t}.", f"d{t}?", ""]) * 3) for c in (1, 2) for t in range(3000)]
    turns = spark.createDataFrame(rows, COLUMNS)
    want = sorted(map(tuple, turn_repair.report(turn_repair.damaged(turns)).collect()))

    def report():
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
        return sorted(map(tuple, turn_repair.report(turn_repair.damaged(turns), spill=1_000).collect()))

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        assert report() == want and want[0][7].count("K") > 300
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_stack_reads_blocks_backwards():
    stack = turn_repair.Stack(10)
    for i in range(25):
        stack.push((i,), 4)
    assert len(stack.ends) > 5
    assert [i for (i,) in stack.reversed()] == list(range(24, -1, -1))


def test_repaired_rows_hash_to_the_report(spark):
    rows = tables(9, 60, 7)
    turns = turn_repair.damaged(spark.createDataFrame(rows, COLUMNS))
    lines = by_conversation([(r.conv_id, r.place, r.edit, r.role, r.text) for r in turn_repair.repaired(turns).collect()])
    for r in turn_repair.report(turns).collect():
        mine = sorted(lines.get(r.conv_id, []), key=lambda x: x[1])
        text = "\n".join(f"{role}:{text}" for *_, role, text in mine)
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256
        assert [e[2][0].upper() for e in mine] == [e for e in r.audit if e != "D"]
        assert well_formed("".join(e[3][0] for e in mine))


def test_empty_tables_and_undamaged_rows(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert turn_repair.report(turn_repair.damaged(none)).count() == 0
    assert turn_repair.repaired(turn_repair.intact(none)).count() == 0
    turns = spark.createDataFrame([(7, 0, "system", "Be kind."), (7, 1, "user", "Hi."), (7, 2, "assistant", "Hello."), (8, 4, None, None)], COLUMNS)
    got = {r.conv_id: (r.cost, r.audit, r.blank) for r in turn_repair.report(turn_repair.intact(turns)).collect()}
    assert got == {7: (0, "KKK", 0), 8: (2, "D", 1)}


def test_very_long_texts(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long + "?"), (1, 1, "assistant", " " * 1_000_000), (1, 2, "assistant", "!" + " " * 1_000_000), (1, 3, "assistant", long)]
    got = turn_repair.report(turn_repair.intact(spark.createDataFrame(rows, COLUMNS))).first()
    assert (got.blank, got.truncated, got.audit) == (1, 1, "KDKD")


def test_one_shuffle_serves_duplicates_and_the_stream(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a.")], COLUMNS)
    plan = turn_repair.report(turn_repair.damaged(turns))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    executed = turn_repair.report(turn_repair.damaged(turns))._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and "PythonUDF" not in executed
