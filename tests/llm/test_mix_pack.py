"""Mixing, packing, embeddings, and the pipeline over all of them."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check import compare, oracle
from loadlake import llm
from loadlake.llm import embeddings, language_id, mixing, packing
from loadlake.llm.queries import pieces_packed
from loadlake.llm.tokens import encoder

# Mixing


@pytest.fixture(scope="module")
def sources(spark):
    return spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, "rare").when(F.col("id") % 7 == 0, None).otherwise("web").alias("source"),
        F.lit("t").alias("text"), F.lit(5).alias("copy"), F.lit(1).alias("_rate"), F.lit(2).alias("_order"),
    )


def shares(df):
    counts = Counter({r["source"]: r["n"] for r in df.groupBy("source").agg(F.count("*").alias("n")).collect()})
    return {s: n / counts.total() for s, n in counts.items()}, counts.total()


def test_targets_are_met(spark, sources):
    weights = spark.createDataFrame([("hot", 1.0), ("rare", 2.0), (None, 1.0), ("absent", 9.0), ("web", 0.0)], "source string, weight double")
    got, rows = shares(mixing.mixed(sources, weights, total=16_000, seed=3))
    assert set(got) == {"hot", "rare", None} and rows == pytest.approx(16_000, rel=0.05)
    assert got["rare"] == pytest.approx(0.5, abs=0.03) and got["hot"] == pytest.approx(0.25, abs=0.03)
    got, rows = shares(mixing.mixed(sources))
    sizes = {s: n for s, n in ((r["source"], r["count"]) for r in sources.groupBy("source").count().collect())}
    whole = sum(map(math.sqrt, sizes.values()))
    assert rows == pytest.approx(20_000, rel=0.05)
    assert all(got[s] == pytest.approx(math.sqrt(n) / whole, abs=0.02) for s, n in sizes.items())


def test_counts_are_poisson_and_repeatable(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    for mean in (0.3, 3.0, 200.0):
        part = docs.limit(500) if mean == 200.0 else docs
        n = part.count()
        copies = mixing.mixed(part, total=mean * n, seed=1).groupBy("doc_id").count()
        counts = np.array([r["count"] for r in copies.collect()] + [0] * (n - copies.count()))
        assert counts.mean() == pytest.approx(mean, rel=0.05) and counts.var() == pytest.approx(mean, rel=0.15)
        if mean == 3.0:
            for k in range(6):
                assert (counts == k).mean() == pytest.approx(math.exp(-3) * 3**k / math.factorial(k), abs=0.01)
    again = [mixing.mixed(docs.repartition(p), total=900, seed=9).collect() for p in (1, 5)]
    assert sorted(again[0]) == sorted(again[1]) and again[0] == again[1]
    assert sorted(mixing.mixed(docs, total=900, seed=8).collect()) != sorted(again[0])


def test_rows_are_shuffled_and_keep_their_columns(spark, sources):
    out = mixing.mixed(sources)
    assert set(out.columns) == set(sources.columns) and out.columns[-1] == "copy"
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert abs(np.corrcoef(np.arange(len(ids)), ids)[0, 1]) < 0.05
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
    assert mixing.mixed(sources.where("false")).count() == 0


def test_rows_of_one_id_and_rows_without_one_draw_a_number_each(spark):
    """A repeated id and NULL ids meet the targets as other rows do, and rows of unique ids keep their numbers."""
    unique = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("u").alias("source"), F.lit(None).cast("string").alias("text"))
    same = spark.range(20_000).select(F.lit(70_000).cast("long").alias("doc_id"), F.lit("h").alias("source"), F.col("id").cast("string").alias("text"))
    none = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("n").alias("source"), F.lit("").alias("text"))
    docs = unique.unionByName(same).unionByName(none)
    weights = spark.createDataFrame([("u", 1.0), ("h", 20.0), ("n", 20.0)], "source string, weight double")
    out = mixing.mixed(docs, weights, total=84_000, seed=5)
    got = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert got["h"] == pytest.approx(41_000, rel=0.03) and got["n"] == pytest.approx(41_000, rel=0.03)
    times = Counter(r["count"] for r in out.where("source = 'h'").groupBy("text").count().collect())
    assert len(times) > 5
    alone = mixing.mixed(unique, total=84_000 / 41, seed=5)
    assert sorted((r["doc_id"], r["copy"]) for r in out.where("source = 'u'").collect()) == sorted((r["doc_id"], r["copy"]) for r in alone.collect())


def test_many_sources_take_salted_joins(spark, sources, monkeypatch):
    whole = sorted((r["doc_id"], r["copy"]) for r in mixing.mixed(sources).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted((r["doc_id"], r["copy"]) for r in mixing.mixed(sources).collect()) == whole


# Packing


def test_ids_are_those_of_the_tokenizer_file(spark, sf_dir):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += ["", " ", "\n\n  a\t b ", "<|endoftext|> x", "naïve ß 漢字 \U0001f600 it's I'LL", "\x00\x1c ​", "a" * 3000, "12345 ...!!"]
    texts += ["a <|endoftext|> x", "<|endoftext|>" * 3 + " \n", "x" + " " * 300_000 + "y", "\n" * 100_000, "\t \n" * 20_000 + "z", "a" * 50_000]
    assert [encoder("byte_bpe_50k.json")(t) for t in texts] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("histogram", [{}, {2048: 7}, {1: 5000}, {1025: 9}, {64: 100, 7: 33, 1984: 12}, {k: 13 * k % 29 for k in range(1, 2048, 31)}])
def test_patterns_hold_every_piece(histogram):
    found = packing.cutting_stock(histogram, 2048)
    held = Counter()
    for p in found:
        assert 0 < p.filled() <= 2048 and p.times > 0
        held.update({length: n * p.times for length, n in p.counts.items()})
    assert held == Counter({k: n for k, n in histogram.items() if n})
    ranks = {}
    for length, first, last, each, _, _ in packing.slots(found):
        assert first == ranks.get(length, 0) and (last - first) % each == 0
        ranks[length] = last
    assert ranks == dict(held)


def test_patterns_are_close_to_the_bound():
    rng = np.random.default_rng(1)
    histogram = Counter(length for n in rng.lognormal(6.5, 1.2, 5000).astype(int) + 1 for _, length in packing.cuts(int(n), 2048, 64))
    used = sum(p.times for p in packing.cutting_stock(histogram, 2048))
    least = sum(k * n for k, n in histogram.items()) / 2048
    assert used <= 1.002 * least + 2


def packed_ids(rows, sequences):
    """Each document's ids put together again from its pieces' places, by (doc_id, copy)."""
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"], sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]))
    return found


def test_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "word " * 9000), (None, "no id")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    pieces = packing.pieces(docs, "byte_bpe_50k.json")
    rows = packing.packed(pieces, 2048).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    whole = {}
    for number, parts in sequences.items():
        parts.sort(key=lambda r: r["offset"])
        at = 0
        for r in parts:
            assert r["offset"] == at and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert at <= 2048
        whole[number] = np.frombuffer(b"".join(bytes(r["ids"]) for r in parts), "<u4")
    filled = sum(map(len, whole.values()))
    assert filled / (2048 * len(whole)) > 0.99
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    back = packed_ids(rows, whole)
    for r in docs.collect():
        parts = sorted(back[r["doc_id"]], key=lambda p: p[0])
        assert np.concatenate([ids for _, _, ids in parts]).tolist() == [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1]
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in pieces_packed(docs).collect()}
    assert digests == {(r["doc_id"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in rows}


def test_copies_are_packed_as_often(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 5 + [(2, "x " * 3000)] * 3, "doc_id long, text string")
    rows = pieces_packed(docs).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 5 * rows[0]["doc_tokens"] or sum(r["doc_id"] == 1 for r in rows) == 5
    assert pieces_packed(docs.where("false")).count() == 0


# Embeddings


def brute_links(vectors, cosine):
    usable = {}
    for i, v, label in vectors:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = (np.array(v, np.float32).astype(float), label)
    ids = sorted(usable)
    return ids, [
        (a, b) for n, b in enumerate(ids) for a in ids[:n]
        if usable[a][1] == usable[b][1] and len(usable[a][0]) == len(usable[b][0])
        and usable[a][0] @ usable[b][0] / np.linalg.norm(usable[a][0]) / np.linalg.norm(usable[b][0]) >= cosine
    ]


@pytest.mark.parametrize(("size", "cosine"), [(64, 0.93), (20, 0.9), (5, 0.99)])
def test_embedding_links_match_brute_force(spark, size, cosine):
    rng = np.random.default_rng(size)
    rows = []
    for centre in range(60):
        base = rng.standard_normal(size)
        for _ in range(6):
            near = base / np.linalg.norm(base) + rng.standard_normal(size) * rng.choice([0.01, 0.03, 0.06, 0.3]) / math.sqrt(size) * 3
            rows.append((len(rows), (near * rng.uniform(0.1, 9)).tolist(), centre % 3))
    rows += [(900 + i, rows[3][1], 0) for i in range(4)]
    rows += [(910, None, 1), (911, [0.0] * size, 1), (912, [float("nan")] * size, 1), (913, [None] * size, 1), (914, rows[0][1], None), (915, [1.0], 1), (916, [], 1)]
    frame = spark.createDataFrame([(i, v, label, 3) for i, v, label in rows], "vec_id long, embedding array<float>, label int, id int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(frame, cosine).collect()}
    _, links = brute_links(rows, cosine)
    of = {i: i for i, _, _ in rows}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            changed |= of[a] != low or of[b] != low
            of[a] = of[b] = low
    degree = Counter(x for pair in links for x in pair)
    assert len(links) > 100
    assert got == {i: (degree[i], of[i], of[i] == i) for i, _, _ in rows}
    assert embeddings.near_duplicates(frame.where("false")).count() == 0


def test_embeddings_of_several_lengths_and_repeated_ids(spark):
    """Vectors meet those of their own length, whatever the others; an id's vectors have the links of each."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(size).tolist(), 1) for i, size in enumerate([64] * 20 + [3] * 2 + [2] * 4 + [70] * 3 + [8] * 3)]
    rows += [(100 + i, [x * 2.5 + 1e-3 for x in rows[i][1]], 1) for i in range(len(rows))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(frame).collect()}
    _, links = brute_links(rows, 0.93)
    degree = Counter(x for pair in links for x in pair)
    assert {len(rows[a % 100][1]) for a, _ in links} == {64, 3, 2, 70, 8} and got == {i: degree[i] for i, _, _ in rows}
    east, north, west = [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]
    again = spark.createDataFrame([(5, east, 1), (5, north, 1), (6, east, 1), (7, west, 1), (8, north, 1), (4, west, 1)], frame.schema)
    found = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(again).collect())
    assert found == [(4, 1, 4, True), (5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 4, False), (8, 1, 5, False)]


# Queries and pipeline


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_its_sql(spark, sf_dir, name):
    assert compare_with(llm.oracle_sql()[name], llm.queries()[name](spark, sf_dir), oracle(sf_dir)) is None


def compare_with(sql, df, con):
    import check

    known = check.oracle_sql
    check.oracle_sql = lambda: {"it": sql}
    try:
        return compare(df, con, "it")
    finally:
        check.oracle_sql = known


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm.queries())
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    junk = spark.createDataFrame([(10**6, "12 !?", "en", "src0", 5), (10**6 + 1, None, None, None, None)], docs.schema)
    copies = docs.where("doc_id < 20").withColumns({"doc_id": F.col("doc_id") + 50_000, "text": F.concat(F.lit(" "), "text")})
    near = docs.where("length(text) > 2000").withColumns({"doc_id": F.col("doc_id") + 60_000, "text": F.concat("text", F.lit(" tail"))})
    start = docs.unionByName(junk).unionByName(copies).unionByName(near)
    given = start
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, sf_dir)
        assert out.columns == docs.columns, name
        before, after = ({r["doc_id"] for r in x.select("doc_id").collect()} for x in (given, out))
        if name == "language_id":
            assert before - after == {10**6, 10**6 + 1}
        elif name != "mixing":
            assert after < before
        given = out
    assert corpus_pipeline.ORACLE_SQL is None
    ids = Counter(r["doc_id"] for r in given.select("doc_id").collect())
    last = corpus_pipeline.STAGES[-1][1](spark, given, sf_dir).where("start = 0").collect()
    assert Counter(r["doc_id"] for r in last) == ids
    assert language_id.UNDETERMINED == "und"
