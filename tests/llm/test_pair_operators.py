"""Jaccard join, repeated strings and decontamination against brute force on small tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusforge.llm import decontaminate, jaccard, repeats
from corpusforge.llm.components import connected
from corpusforge.llm.suffixes import common_prefixes, suffix_array

WORDS = [f"w{i}" for i in range(60)]


def near_copies(seed):
    """Texts of all kinds: families of near copies, shared passages, short and empty ones, nulls, upper case."""
    rng = random.Random(seed)
    texts = [None, "", " \n", "one two", "One  TWO", "a b c d e"]
    passage = " ".join(rng.choice(WORDS) for _ in range(70))
    for _ in range(12):
        base = [rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(rng.randrange(20, 160))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            other = list(base)
            for _ in range(rng.randrange(4)):
                other[rng.randrange(len(other))] = rng.choice(WORDS)
            texts.append(" ".join(other))
        texts.append(passage + " " + " ".join(base[:30]))
    return texts + texts[6:12]


def brute_components(texts):
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(sets[i]), find(i)) for i in range(len(texts))]


@pytest.mark.parametrize("common", [1, 16])
def test_components_equal_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    texts = near_copies(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = jaccard.join_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_components(texts)


def test_rows_without_id_and_repeated_rows(spark):
    text = " ".join(WORDS[:20])
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (None, "x y"), (9, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_classes(docs).collect()}
    assert got == {(None, 16, 4), (4, 16, 4), (None, 1, None), (9, 0, 9)}
    assert jaccard.join_classes(docs.where("doc_id = 77")).count() == 0


def test_bound_never_below_the_overlap():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 2000)).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        assert jaccard.overlap_bound(jaccard.signature(a), jaccard.signature(b), len(a), len(b)) >= shared


def test_parities_part_large_sets_that_share_much():
    import numpy as np

    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 700).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[:560], rng.integers(0, 2**63, 140).astype(np.uint64)])) for _ in range(12)]
    pairs = [(a, b) for i, a in enumerate(sets) for b in sets[:i]]
    assert all(len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.7 for a, b in pairs)
    assert not any(jaccard._bound_ok(len(a), jaccard.signature(a), len(b), jaccard.signature(b), 80) for a, b in pairs)


def test_large_family_makes_few_pairs(spark, monkeypatch):
    """Links beside the centre are found by pairs in proportion to a family, not to its square."""
    rng, checked, links = random.Random(31), [], jaccard.verified
    base = [f"{rng.choice(WORDS)}{i}" for i in range(150)]
    texts = []
    for number in range(240):
        words = list(base)
        for at in rng.sample(range(2, 148), 2 if number % 3 else 3):
            words[at] = f"x{number}y{at}"
        texts.append(" ".join(words))

    def counted(pairs, *rest):
        checked.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counted)
    monkeypatch.setattr(jaccard, "hub_pairs", lambda sets: spark.createDataFrame([], "a long, b long"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard.join_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    want = brute_components(texts)
    assert sorted(map(tuple, got)) == want and len({root for _, _, root in want}) < 200
    assert len(texts) / 20 < sum(checked) < 12 * len(texts), checked


def test_hubs_are_chosen_without_python(spark, capsys):
    """Both passes over the shingles of least hash went through Python."""
    texts = near_copies(7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = jaccard.stage(jaccard.profiles(docs).where("n > 0").dropDuplicates(["key"]), "sets")
    pairs = jaccard.hub_pairs(sets)
    pairs.explain()
    plan = capsys.readouterr().out
    assert "Generate explode(least" in plan and "InPandas" not in plan, plan
    rows = {r.doc_id: r for r in sets.collect()}
    least = {i: jaccard.shingle_sets([texts[i].encode()], 5)[0][: jaccard.LEADS].astype("<i8").tolist() for i in rows}
    assert {i: r.least for i, r in rows.items()} == least
    expected = {}
    for i, tokens in least.items():
        for token in tokens:
            expected.setdefault(token, []).append(i)
    share = lambda i: (rows[i].n_rare / max(1, len(rows[i].lead) / 8), rows[i].n, i)
    centres = {(i, min(ids, key=share)) for ids in expected.values() for i in ids}
    found = set(map(tuple, pairs.collect()))
    assert {(a, b) for a, b in centres if a != b} <= found
    assert all(a != b and set(least[a]) & set(least[b]) for a, b in found)


def test_family_on_both_sides_of_the_threshold(spark):
    """One large family of near copies: some pairs link, others just do not; and a family in which none do."""
    rng = random.Random(23)
    texts = []
    for most in (5, 14):
        base = [f"{rng.choice(WORDS)}{i}" for i in range(120)]
        for number in range(60):
            words = list(base)
            for at in rng.sample(range(120), rng.randrange(1, most) if most == 5 else 13):
                words[at] = f"x{number}y{at}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_components(texts)
    assert 3 < len({root for _, _, root in want[:60]}) < 60 or len({root for _, _, root in want[:60]}) == 1
    assert len({root for _, _, root in want[60:]}) > 1
    got = jaccard.join_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_connected_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.root for r in connected(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_suffix_arrays_by_grouping():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(16))]
        order = suffix_array(s)
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        shared = common_prefixes(s, order, 0)
        for k in range(1, len(order)):
            a, b = s[order[k - 1] :], s[order[k] :]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def brute_cut(texts, length):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for k in range(len(d) - length + 1):
            seen[d[k : k + length]] = seen.get(d[k : k + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [2, 2000])
def test_repeated_strings_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passage, long_passage = letters(405), letters(700)
    texts = [None, "", letters(399), passage[:399], letters(900), "x" * 1500, "For " * 300]
    for _ in range(14):
        texts.append(letters(rng.randrange(300)) + passage + letters(rng.randrange(300)))
        texts.append(letters(rng.randrange(500)) + long_passage[rng.randrange(200) :] + letters(rng.randrange(500)))
    texts += [texts[8], texts[9]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = repeats.cut(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).orderBy("doc_id")
    assert [tuple(r)[1:] for r in got.collect()] == brute_cut(texts, 400)


def test_repeated_rows_repeat_each_other(spark):
    text = "".join(random.Random(2).choice("abc ") for _ in range(500))
    docs = spark.createDataFrame([(1, text, 500), (1, text, 500), (None, text[:450], 450), (2, "kept", 4)], "doc_id long, text string, n_chars long")
    got = repeats.without_repeats(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "", 0), (1, "", 0), (1, "", 0), (2, "kept", 4)]
    assert repeats.cut(docs.where("doc_id = 5")).count() == 0


def test_contamination_cases(spark):
    ten = " ".join(f"t{i}" for i in range(12))
    items = spark.createDataFrame([(1, ten), (2, "Short one"), (3, None), (4, "!!"), (None, ten), (1, ten)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x " + ten.upper() + " y"), (2, "a short, one! b"), (3, None), (4, ""), (5, "t0 t1 t2"), (1, "x " + ten.upper() + " y"), (None, "short one")],
        "doc_id long, text string",
    ).withColumn("hash", F.lit("clash"))
    empty = hashlib.sha256(b"").hexdigest()
    ids = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = [tuple(r) for r in decontaminate.digest(decontaminate.contamination(docs, items)).collect()]
    want = [
        (1, 14, 12, 1, ids("1"), True), (1, 14, 12, 1, ids("1"), True), (2, 4, 2, 1, ids("2"), True), (3, 0, 0, 0, empty, False),
        (4, 0, 0, 0, empty, False), (5, 3, 0, 0, empty, False), (None, 2, 2, 1, ids("2"), True),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    cleaned = {(r.doc_id, r.text) for r in decontaminate.decontaminate(docs, items, action="spans").collect()}
    assert (2, "a b") in cleaned and (1, "x y") in cleaned and (5, "t0 t1 t2") in cleaned
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, items).collect()) == [3, 4, 5]
    none = items.where("item_id = 9")
    assert decontaminate.contamination(docs, none).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.where("doc_id = 9"), items).count() == 0


def test_windows_of_several_lengths(spark):
    """Items of 1 to 14 words give windows of ten lengths; starts in the texts are those of brute force."""
    rng = random.Random(11)
    some = [f"w{i}" for i in range(12)]
    items = [(n, " ".join(rng.choice(some) for _ in range(n))) for n in range(2, 15)] + [(15, "w3")]
    texts = [(n, " ".join(rng.choice(some) for _ in range(rng.randrange(30)))) for n in range(40)] + [(50, "x " + items[11][1] + " " + items[4][1])]
    found = decontaminate.find_hits(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: ([tuple(s) for s in r.spans], list(r.item_ids)) for r in found.collect()}
    for doc_id, text in texts:
        words, spans, ids = text.split(), set(), set()
        for item_id, item in items:
            of = item.split()
            for at in range(max(1, len(of) - 9)):
                window = of[at : at + 10]
                hits = {(k, len(window)) for k in range(len(words) - len(window) + 1) if words[k : k + len(window)] == window}
                spans |= hits
                ids |= {str(item_id)} if hits else set()
        assert got[doc_id] == (sorted(spans), sorted(ids))


@pytest.mark.parametrize("few", [True, False])
def test_contaminated_documents_go_without_a_shuffle_of_texts(spark, monkeypatch, few):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 100 if few else 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "a b c"), (2, "x"), (None, "a b c"), (None, "y"), (1, "z")], "doc_id long, text string")
        left = decontaminate.decontaminate(docs, spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
        assert ("Exchange hashpartitioning" in left._jdf.queryExecution().executedPlan().toString()) != few
        assert sorted((r.text, r.doc_id) for r in left.collect()) == [("x", 2), ("y", None), ("z", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_windows_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 2)
    ten = " ".join(f"t{i}" for i in range(15))
    items = spark.createDataFrame([(1, ten)], "item_id long, text string")
    docs = spark.createDataFrame([(1, ten), (2, "nothing")], "doc_id long, text string")
    assert {(r.doc_id, r.n_hit) for r in decontaminate.contamination(docs, items).collect()} == {(1, 15), (2, 0)}


def brute_words(texts, length):
    """Texts without the words that a row of ``length`` words covers which stands elsewhere too."""
    split = [[(m.start(), m[0].strip(".,\"")) for m in re.finditer(r"\S+\s*", t)] for t in texts]
    bare = [[w.strip().strip(".,\"") for _, w in words] for words in split]
    seen = {}
    for words in bare:
        for k in range(len(words) - length + 1):
            seen[tuple(words[k : k + length])] = seen.get(tuple(words[k : k + length]), 0) + 1
    out = []
    for text, words, places in zip(texts, bare, split):
        gone = {j for k in range(len(words) - length + 1) if seen[tuple(words[k : k + length])] > 1 for j in range(k, k + length)}
        edges = [p for p, _ in places] + [len(text)]
        out.append(text[: edges[0]] + "".join(text[edges[j] : edges[j + 1]] for j in range(len(words)) if j not in gone))
    return out


@pytest.mark.parametrize("crowd", [2, 2000])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(13)
    row = lambda n: "".join(rng.choice(["a", "be", "ü", "cat", "dogs", "é."]) + rng.choice([" ", "\n", "  "]) for _ in range(n))
    exact, short, long = row(51), row(50), row(130)
    texts = ["", " \n", row(50), "x " * 200, " lead" + row(60), "For a, " * 40]
    for _ in range(12):
        texts.append(row(rng.randrange(40)) + exact + row(rng.randrange(40)))
        texts.append(row(rng.randrange(40)) + f"q{rng.randrange(10**6)} " + short + f"q{rng.randrange(10**6)}")
        texts.append(row(rng.randrange(40)) + long[rng.randrange(60) :] + row(rng.randrange(90)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = [r.text for r in repeats.without_passages(docs).orderBy("doc_id").collect()]
    assert got == brute_words(texts, 51)


def test_only_texts_that_lose_something_go_to_python_and_once(spark, capsys):
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [f"one {passage} é", f"two {passage}", "clean", None, ""]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    for make in (repeats.without_passages, repeats.cut):
        make(docs).explain()
        plan = capsys.readouterr().out
        assert plan.count("ArrowEvalPython") == 1 and "isnotnull(runs" in plan, plan
    got = repeats.without_passages(docs).orderBy("doc_id").collect()
    assert [(r.text, r.n_chars) for r in got] == [("one é", 5), ("two ", 4), ("clean", 5), (None, None), ("", 0)]
    got = repeats.cut(docs.where("doc_id > 1")).orderBy("doc_id").collect()
    assert [(bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got] == [(b"clean", 5, 0, 0), (b"", 0, 0, 0), (b"", 0, 0, 0)]


def test_bitmaps_reach_the_driver_in_few_jobs(spark):
    """One job per partition made most of the time of a run of many partitions."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i + k) % 90}" for k in range(100))) for i in range(300)], "doc_id long, text string")
    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in changed}
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        began = jobs()
        bitmap, levels = jaccard._common_tokens(docs, 5, 80, 1), repeats._repeated_anchors(docs, repeats.WORDS)
        assert jobs() - began < 12
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    least = [jaccard.shingle_sets([row.text.encode()], 5)[0][:1] for row in docs.collect()]
    token, count = jaccard.np.unique(jaccard.np.concatenate(least), return_counts=True)
    often = token[count > jaccard.COMMON]
    assert len(often) and jaccard._has(bitmap, (often & jaccard.np.uint64(jaccard.BITS - 1)).astype("int64")).all()
    assert len(levels) == repeats.CELLS and levels.any()


def test_passage_between_signs_and_without_blanks(spark):
    rng = random.Random(3)
    words = " ".join(rng.choice("abcdefgh") for _ in range(51))
    signs = "".join(chr(0x4E00 + rng.randrange(500)) for _ in range(60))
    texts = [f'one "{words}." two', f"three ({words}), four", f"five {signs} six", f"seven{signs}eight", "clean " + words[2:], None]
    got = repeats.without_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["one two", "three four", "five six", "seveneight", "clean " + words[2:], None]


def test_removed_spans_keep_capitals_around_them(spark):
    item = " ".join(f"q{i}" for i in range(10))
    text = f"The BIG Cat said NO and {item.upper()}! Then left, ÉTÉ [x]"
    docs = spark.createDataFrame([(1, text), (2, f"{item} {item}"), (3, f"A\n{item}")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, action="spans").collect()}
    assert got == {1: "The BIG Cat said NO and Then left, ÉTÉ [x]", 2: "", 3: "A\n"}


def test_links_through_rows_without_id_and_of_one_id(spark):
    """A null id bridges two documents, gets their component, and one id may have several texts."""
    words = [f"b{i}" for i in range(100)]
    bridge = [*words[:94], *[f"c{i}" for i in range(6)]]
    far = [*words[:88], *[f"d{i}" for i in range(6)], *[f"c{i}" for i in range(6)]]
    other, alone = " ".join(f"z{i}" for i in range(50)), "no id at all here"
    rows = [(1, " ".join(words)), (None, " ".join(bridge)), (2, " ".join(far)), (7, " ".join(words)), (7, other), (5, other), (5, alone), (None, alone + " x"), (None, alone + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [text for _, text in rows]
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) or {tuple(t.split())} for t in texts]
    link = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert link(sets[0], sets[1]) and link(sets[1], sets[2]) and not link(sets[0], sets[2])
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.join_classes(docs).collect()), key=str)
    assert got == sorted([(1, 1), (None, 1), (2, 1), (7, 1), (7, 5), (5, 5), (5, 5), (None, None), (None, None)], key=str)
