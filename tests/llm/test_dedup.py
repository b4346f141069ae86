"""Exact and near duplicates, components and repeated passages against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import functions as F

from loadlake.llm import jaccard, simhash, substrings
from loadlake.llm.components import components
from loadlake.llm.exact_dedup import exact_duplicates, without_copies
from loadlake.llm.scratch import Scratch

DOCS = "doc_id long, text string, lang string, half string, component_id long, _id long, copy int"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, "x", 7, 3, 1) for i, t in rows], DOCS)


def roots(nodes, links):
    of = {n: n for n in nodes}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        of[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(0, i) for i in range(1, 60)] + [(100, 101), (101, 100), (102, 102), (None, 5)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
        "none": [],
    }[shape]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    plain = [(a, b) for a, b in links if a is not None and a != b]
    assert got == roots({n for pair in plain for n in pair}, plain)


EXACT = [
    (1, "a b c"), (2, "abc"), (3, " a\tb\nc "), (4, "abd"), (5, None), (6, ""), (7, " \n\x0b\x0c\r"), (8, "a b"), (9, "x" * 5000),
    (10, "x" * 5000), (11, "x" * 4999 + "y"), (12, "b" * 300 + "q"), (13, "b" * 300 + "r"), (2, "abc"), (None, "abc"), (14, "ä"), (15, "ä"),
]


def test_exact_duplicates_keep_the_longest_then_the_smallest_id(spark):
    got = sorted(map(tuple, exact_duplicates(frame(spark, EXACT)).collect()), key=str)
    groups = {}
    for i, text in EXACT:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i))
    want = []
    for members in groups.values():
        keep = min(members)[2]
        want += [(i, keep, len(members), i == keep) for _, _, i in members]
    assert got == sorted(want, key=str)


def test_the_query_gives_one_row_per_row(spark, tmp_path):
    from loadlake.llm.queries import op7_exact_dedup

    rows = EXACT + [(None, "no other"), (9, "another text"), (9, "another text"), (2, "abc")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op7_exact_dedup(spark, str(tmp_path))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    digest = [(i, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()) for i, t in rows]
    got = got.collect()
    assert sorted(((r["doc_id"], r["text_sha256"]) for r in got), key=str) == sorted(digest, key=str)
    alone = [r for r in got if r["doc_id"] is None and r["group_size"] == 1]
    assert len(alone) == 1 and alone[0]["kept"] and alone[0]["keep_id"] is None


def test_exact_copies_go_and_other_columns_stay(spark):
    kept = without_copies(frame(spark, EXACT))
    assert kept.columns == frame(spark, EXACT).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 7, 8, 9, 11, 12, 13, 14, 15]
    assert without_copies(frame(spark, [])).count() == 0


def brute_mark(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_hand(spark):
    texts = [None, "", " \n", "One", "one TWO", "a b c", "a b c d", "Ä É x y z ẞ", "w " * 40_000, "x y z q"]
    marks = simhash.fingerprints(frame(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["fingerprint"] % 2**64 for r in marks} == {i: brute_mark(t, 3) for i, t in enumerate(texts)}
    # The hash is the one Spark itself calls xxhash64, whose seed is 42.
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_links_find_every_pair_within_three_bits(spark):
    rng = random.Random(5)
    marks = {0, 2**64 - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        marks.add(base)
        for flips in (1, 2, 3, 3, 4, 5):
            marks.add(base ^ sum(1 << b for b in rng.sample(range(64), flips)))
    listed = sorted(marks)
    frame_ = spark.createDataFrame([(i, m - 2**64 if m >= 2**63 else m) for i, m in enumerate(listed)], "id long, fingerprint long")
    for distance in (3, 1):
        got = {(r["a"], r["b"]) if r["a"] < r["b"] else (r["b"], r["a"]) for r in simhash.links(frame_, distance).collect()}
        assert got == {(i, j) for j in range(len(listed)) for i in range(j) if (listed[i] ^ listed[j]).bit_count() <= distance}


def test_near_duplicates_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = {r["doc_id"]: brute_mark(r["text"], 3) for r in docs.collect()}
    links = [(i, j) for i in marks for j in marks if i < j and (marks[i] ^ marks[j]).bit_count() <= 3]
    want = {i: (f"{marks[i]:016x}", root) for i, root in roots(marks, links).items()}
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want
    kept = simhash.without_near_copies(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, root) in want.items() if i == root)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(3, None), (2, ""), (5, "a b c"), (4, "A b C"), (4, "A b C"), (None, "a b c"), (9, "q r s t u")]
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(frame(spark, rows)).collect())
    assert got == [("2", "2"), ("3", "2"), ("4", "4"), ("4", "4"), ("5", "4"), ("9", "9"), ("None", "4")]
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.without_near_copies(frame(spark, rows)).columns[2] == "lang"


def five_words(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def kept_by_brute_force(docs, similarity=0.8):
    sets = {i: five_words(t) for i, t in docs if i is not None}
    links = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9]
    return {i for i, root in roots(sets, links).items() if i == root}, links


def test_the_pipeline_links_all_texts_that_share_four_fifths_of_five_words(spark):
    """Pairs from 0.7 to 1, a large group, chains and a passage many texts begin with; most pairs differ in more than three bits."""
    from corpus_pipeline import without_near_copies

    rng = random.Random(11)
    shared = [f"s{i}" for i in range(40)]
    docs = [(None, "a b"), (700, None), (701, " "), (702, "one two"), (703, "One TWO"), (704, "one"), (705, "a b c d e f g h"), (706, "a b c d e f g h i")]
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(20, 200))]
        words = shared + words if i % 3 == 0 else words
        docs.append((3 * i, " ".join(words)))
        for k in (1, 2):
            words = list(words)
            for _ in range(rng.randrange(1, 1 + max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = "edited" + str(rng.randrange(99))
            docs.append((3 * i + k, " ".join(words)))
    base = [f"g{i}" for i in range(100)]
    docs += [(1000 + i, " ".join(base[:i] + ["x" + str(i)] + base[i + 1 :])) for i in range(100)]
    want, links = kept_by_brute_force(docs)
    far = [1 for i, j in links if (brute_mark(dict(docs)[i], 3) ^ brute_mark(dict(docs)[j], 3)).bit_count() > 3]
    assert len(far) > len(links) / 2
    kept = without_near_copies(spark, frame(spark, docs), "")
    assert kept.columns == frame(spark, docs).columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(want)
    assert kept.where("doc_id IS NULL").count() == 1
    search = jaccard.connected(frame(spark, docs).where("doc_id IS NOT NULL"), 5, 0.8, "text", "doc_id", Scratch(spark))
    assert search.found.count() < len(links)
    assert without_near_copies(spark, frame(spark, []), "").count() == 0


def brute_passages(docs, window):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for at in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][at : at + window]), i)
    found = {}
    for i, w in words.items():
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < i:
                gone.update(range(at, at + window))
        kept = " ".join(x for at, x in enumerate(w) if at not in gone)
        found[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return found


def as_found(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_repeated_passages_match_brute_force(spark, seed):
    """Texts glued from shared passages, of few and of many different words, with edits and repeats inside a text."""
    rng = random.Random(seed)
    pool = [[rng.choice("abcdefgh") + str(rng.randrange([2, 40, 10_000][seed])) for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    docs = []
    for i in range(60):
        words = [w for _ in range(rng.randrange(0, 6)) for w in rng.choice(pool)]
        if words and rng.random() < 0.5:
            words[rng.randrange(len(words))] = "edited"
        docs.append((i * 3, rng.choice([" ", "\n", " \t"]).join(words) + rng.choice(["", " "])))
    docs += [(500, None), (501, ""), (502, " "), (503, "z " * 300), (504, "z " * 300), (505, "z"), (506, " ".join(pool[0]) + " x")]
    for window, k in ((20, 5), (20, 10), (12, 3)):
        got = as_found(substrings.repeated_passages(frame(spark, docs), window, k))
        assert got == brute_passages(docs, window), (window, k)


def test_repeated_passages_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text), (1, text), (None, text), (2, text + " more"), (3, None)]
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substrings.repeated_passages(frame(spark, rows)).collect())
    assert got == [("1", 80, 0), ("1", 80, 0), ("2", 81, 80), ("3", 0, 0), ("None", 80, 0)]
    assert substrings.repeated_passages(frame(spark, [])).count() == 0


def test_repeated_passages_of_an_id_with_several_texts(spark):
    """Each text of an id is judged by its own words, whichever way its windows meet others."""
    first = [f"w{i}" for i in range(300)]
    rows = [
        (1, " ".join(first)),
        (2, " ".join(first)),
        (2, "short one"),
        (2, " ".join(["x"] + first[100:200])),
        (2, " ".join(f"v{i}" for i in range(70))),
        (2, None),
        (3, " ".join(f"v{i}" for i in range(60))),
        (3, "long " * 200_000),
        (3, "long " * 200_000),
    ]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.repeated_passages(frame(spark, rows)).collect())
    assert got == [(1, 300, 0), (2, 0, 0), (2, 2, 0), (2, 70, 0), (2, 101, 100), (2, 300, 300), (3, 60, 60), (3, 200_000, 0), (3, 200_000, 0)]


def test_paths_are_shorter_than_their_kmers(spark):
    """A long copy is one row of a path, however many edges it has."""
    text = " ".join(f"w{i}" for i in range(3000))
    docs = spark.createDataFrame([(1, 0, text), (2, 0, text)], "doc long, part long, text string")
    edges = substrings.edges(docs, 50, 10)
    assert edges.count() > 200
    assert substrings.paths(edges, 10).count() == 2
    assert as_found(substrings.repeated_passages(docs.withColumnRenamed("doc", "doc_id")).where(F.col("doc_id") == 2))[2][1] == 3000


def test_stages_judge_rows_and_not_ids(spark):
    """One id on several texts, repeated rows, rows without an id, columns named like the operators' own."""
    from corpus_pipeline import without_copies as exact_stage
    from corpus_pipeline import without_near_copies

    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    near = long.replace("w59", "edited")
    rows = [(1, long), (2, long), (2, other), (2, other), (3, near), (None, long), (None, "alone"), (None, None), (4, ""), (4, " ")]
    docs = frame(spark, rows).select("*", F.lit(1).alias("row"), F.lit(2).alias("doc"), F.lit(3).alias("node"))
    for repeat in (4,):
        exact = exact_stage(spark, docs.repartition(repeat), "")
        assert exact.columns == docs.columns
        assert sorted((str(r["doc_id"]), r["text"]) for r in exact.collect()) == sorted(
            [("1", long), ("2", other), ("3", near), ("None", "alone"), ("4", " ")]
        )
        kept = without_near_copies(spark, docs.repartition(repeat), "")
        assert kept.columns == docs.columns
        got = sorted((str(r["doc_id"]), r["text"]) for r in kept.collect())
        assert [g for g in got if g[0] != "4"] == [("1", long), ("2", other), ("None", "alone")]
        assert [g[0] for g in got].count("4") == 1 and len(got) == 4


def test_large_groups_cost_a_comparison_a_text(spark):
    """Near copies that differ in different places: each shingle has another lead, yet few pairs are compared."""
    rng = random.Random(8)
    base = [f"g{i}" for i in range(300)]
    docs = []
    for i in range(200):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(300)] = f"x{rng.randrange(9999)}"
        docs.append((i, " ".join(words)))
    search = jaccard.connected(frame(spark, docs), 5, 0.8, "text", "doc_id", Scratch(spark))
    assert search.found.count() < 3 * len(docs)
    _, links = kept_by_brute_force(docs)
    want = roots({i for i, _ in docs}, links)
    assert {r["node"]: r["component"] for r in search.groups.collect()} == {i: c for i, c in want.items() if list(want.values()).count(c) > 1}


def test_texts_that_share_too_little_meet_no_more(spark, monkeypatch):
    """Long edits of one text, too far apart: what they share comes late in the common order, so that all pairs need not be made."""
    base = [f"g{i}" for i in range(700)]
    docs = [(i, " ".join(f"x{i}" if at % 28 == i % 28 else w for at, w in enumerate(base))) for i in range(60)]
    made = {}
    look_at = jaccard.Search.look_at

    def watched(search, pairs, name):
        made[name] = pairs.count()
        look_at(search, pairs, name)

    monkeypatch.setattr(jaccard.Search, "look_at", watched)
    search = jaccard.connected(frame(spark, docs), 5, 0.8, "text", "doc_id", Scratch(spark))
    _, links = kept_by_brute_force(docs)
    got = {} if search.groups is None else {r["node"]: r["component"] for r in search.groups.collect()}
    want = roots({i for i, _ in docs}, links)
    assert got == {i: c for i, c in want.items() if list(want.values()).count(c) > 1}
    assert made["others"] < len(docs)


def test_prefixes_are_shuffled_once_and_shared_shingles_once_more(spark, monkeypatch, capsys):
    """Until texts meet their leads; broadcasts, which only small tables get, are off."""
    plans = []

    def planned(df):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)

    stored, look_at = Scratch.stored, jaccard.Search.look_at

    def watched_table(scratch, df, name, *more):
        planned(df)
        return stored(scratch, df, name, *more)

    def watched_pairs(search, pairs, name):
        planned(pairs)
        if name == "leads-of":
            monkeypatch.setattr(Scratch, "stored", stored)
            monkeypatch.setattr(jaccard.Search, "look_at", look_at)
        look_at(search, pairs, name)

    monkeypatch.setattr(Scratch, "stored", watched_table)
    monkeypatch.setattr(jaccard.Search, "look_at", watched_pairs)
    docs = [(i, " ".join(f"w{i % 10}-{k}" if k != i else "edited" for k in range(120))) for i in range(20)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        search = jaccard.connected(frame(spark, docs), 5, 0.8, "text", "doc_id", Scratch(spark))
        assert sorted((r["node"], r["component"]) for r in search.groups.collect()) == [(i, i % 10) for i in range(20)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for plan in plans for line in plan.splitlines() if "Exchange hashpartitioning(shingle" in line]
    assert len(shuffles) == 2
    # The hashes that order leads are made behind it.
    assert not any("Window" in plan and "xxhash64" in plan[plan.index("Exchange hashpartitioning(shingle"):] for plan in plans)


@pytest.mark.parametrize("links_per_task", [7, 1000])
def test_components_in_few_tasks(spark, links_per_task):
    rng = random.Random(4)
    links = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b", links_per_task)
    assert len(got.inputFiles()) <= -(-len(links) // links_per_task)
    plain = [(a, b) for a, b in links if a != b]
    assert {r["node"]: r["component"] for r in got.collect()} == roots({n for pair in plain for n in pair}, plain)
