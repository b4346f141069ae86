"""Periodic runs, SentencePiece ids and importance resampling against brute force and the library."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from check import compare, oracle
from loadlake import llm
from loadlake.llm import periodic_runs, resampling, sentencepieces

SCHEMA = "doc_id long, text string, lang string, ids string, runs string, row string, rank string, _text string, score string"


def frame(spark, rows, schema=SCHEMA):
    """(doc_id, text) rows with columns named like the results."""
    return spark.createDataFrame([(i, t, None, "x", "y", "z", "w", "v", "u") for i, t in rows], schema)


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op13_resampling"])
def test_whole_query_with_sql(spark, sf_dir, name):
    assert compare(llm.queries()[name](spark, sf_dir), oracle(sf_dir), name) is None


# Periodic runs


def brute_runs(w, least, times):
    """Every period in turn, smallest first: stretches of words that equal those a period on."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, times * q):
                found.setdefault((s, i - s + q), q)
    return sorted([(s, n, q) for (s, n), q in found.items()], key=lambda r: (r[0], r[2]))


def periodic_text(rng):
    letters = [b"%d" % i for i in range(rng.choice([1, 2, 3, 10]))]
    if rng.random() < 0.3:
        return [rng.choice(letters) for _ in range(rng.randrange(90))]
    out = []
    for _ in range(rng.randrange(8)):
        block = [rng.choice(letters) for _ in range(rng.randrange(1, 9))]
        out += (block * 12)[: rng.randrange(1, 60)] + [rng.choice(letters)]
    return out


def test_runs_by_brute_force():
    rng, seen = random.Random(11), 0
    for _ in range(1500):
        least, times = rng.choice([(24, 3), (6, 3), (3, 3), (8, 4), (10, 5), (1, 3)])
        texts = [periodic_text(rng) for _ in range(rng.randrange(1, 6))]
        want = [brute_runs(w, least, times) for w in texts]
        assert periodic_runs.runs_of(texts, least, times) == want
        seen += sum(map(len, want))
    assert seen > 5000


def test_runs_of_long_and_nested_periods():
    inner = [b"a", b"b"] * 20 + [b"c"]
    got = periodic_runs.runs_of([inner * 5, [b"a"] * 50_000, []], 24, 3)
    assert got[0] == brute_runs(inner * 5, 24, 3) and {r[2] for r in got[0]} == {2, 41}
    assert got[1] == [(0, 50_000, 1)] and got[2] == []
    line = [b"%d" % i for i in range(22)]  # a line that comes back at uneven distances is no run
    assert periodic_runs.runs_of([[w for i in range(2_000) for w in [*line, b"x%d" % i]]], 24, 3) == [[]]


def test_run_rows(spark):
    long = "lorem ipsum " * 60_000 + "end"
    docs = frame(spark, [(1, "a b c " * 9 + "z"), (1, "a b c " * 9 + "z"), (None, "q " * 30), (2, None), (3, ""), (4, " \n "), (5, long)])
    got = {}
    for r in periodic_runs.periodic_runs(docs).collect():
        got.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["collapsed"]))
    assert got[1] == [([(0, 27, 3)], "a b c z")] * 2
    assert got[None] == [([(0, 30, 1)], "q")]
    assert got[2] == got[3] == got[4] == [([], "")]
    assert got[5] == [([(0, 120_000, 2)], "lorem ipsum end")]
    assert periodic_runs.periodic_runs(docs.limit(0)).columns == ["doc_id", "runs", "collapsed"]
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, min_exponent=2)


def test_longest_run_is_compared_exactly(spark):
    rows = [([(5, 30, 7), (9, 60, 14), (1, 31, 7), (2, 62, 14)],), ([],)]
    table = spark.createDataFrame(rows, "runs array<struct<start: long, length: long, period: long>>")
    got = [r["r"] for r in table.select(periodic_runs.longest(F.col("runs")).alias("r")).collect()]
    assert tuple(got[0]) == (1, 31, 7) and got[1] is None


def test_made_periodic(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 40))) for i in range(400)] + [(None, "a b")]
    docs = frame(spark, rows)
    for r in docs.select("doc_id", "text", periodic_runs.made_periodic(F.col("text"), F.col("doc_id")).alias("made")).collect():
        w, h = r["text"].split(), zlib.crc32(str(r["doc_id"]).encode())
        if r["doc_id"] is not None and h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert r["made"].split() == w


# SentencePiece ids

VOCABULARY = "piece_bpe_32k.model"
ODD = ["", " ", "  a", "a  b ", "▁x", "a\tb\n\nc", "é日本語𠀀\u0000z", "<s> </s> <unk> <0x41>", "ﬁ Ａ", "﻿x", "\r\n", "�", " " * 999, "a" * 999, "ab" * 333, "aab" * 99]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))


def test_pieces_by_the_library(library):
    rng, own = random.Random(12), sentencepieces.model(VOCABULARY)
    pieces = [library.id_to_piece(i).replace("▁", "") for i in range(259, 32_000)]
    alphabets = ["ab ", "etaoin shrdlu", "".join(map(chr, range(33, 127))), "日本語の文字 é\n\t  ", "".join(map(chr, range(1, 0x3000)))]
    texts = list(ODD)
    for _ in range(150):
        texts += ["".join(rng.choice(a) for _ in range(rng.randrange(300))) for a in alphabets]
        texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(5)]
    texts.append("".join(rng.choice(alphabets[2]) for _ in range(100_000)))
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == want
        assert own.decode(ids) == library.decode(want)


def test_any_ids_decode_as_in_the_library(library):
    rng, own = random.Random(13), sentencepieces.model(VOCABULARY)
    for _ in range(2_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randrange(12))]
        assert own.decode(np.array(ids, "<u4")) == library.decode(ids)


def test_piece_rows(spark, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "BATCH_BYTES", 100)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, "again"), (1, "again"), (None, None), (None, "x")]
    got = sentencepieces.decoded(sentencepieces.encoded(frame(spark, rows), VOCABULARY).withColumn("decoded", F.lit(5)), VOCABULARY)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, np.array(ids, "<u4").tobytes(), library.decode(ids)))
    assert sorted(map(repr, ((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in got.collect()))) == sorted(map(repr, want))
    assert sentencepieces.encoded(frame(spark, rows).limit(0), VOCABULARY).count() == 0
    assert sentencepieces.decoded(spark.createDataFrame([(None,)], "ids binary"), VOCABULARY).first()["decoded"] is None


def test_whole_table_by_the_library(spark, sf_dir, library):
    got = {r["doc_id"]: r for r in llm.queries()["op12_sentencepiece"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        r = got[doc_id]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# Resampling


def brute_draw(rows, target, percent, min_words, buckets, width, seed):
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [" ".join(w[i : i + n]) for n in range(1, width + 1) for i in range(len(w) - n + 1)]

    def count(texts):
        n = [0] * buckets
        for t in texts:
            for f in feats(t)[1]:
                n[zlib.crc32(f.encode()) % buckets] += 1
        return n

    s, t = count(x for _, x in rows), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    scored = []
    for i, text in rows:
        n, found = feats(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    k = percent * len(able) // 100
    return [(i, m, w, z) for i, _, m, w, z in scored], [(r[0], r[4], place + 1) for place, r in enumerate(able[:k])]


def corpus(n, seed):
    rng = random.Random(seed)
    known = [f"{a}{b}" for a in "abcdefgh" for b in "ÄéxyzK09"]
    return [" ".join(rng.choice(known) + rng.choice(["", ",", "\n", "-Q"]) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize(("percent", "width", "buckets"), [(10, 1, 10_000), (37, 2, 97), (100, 1, 7)])
def test_draw_by_brute_force(spark, percent, width, buckets):
    rows = list(zip(random.Random(4).sample(range(10_000), 700), corpus(700, 1), strict=True))
    target = corpus(20, 2)[:10] + ["", None]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = resampling.resampled(frame(spark, rows).repartition(5), goal, percent, 20, buckets, width, 2024).collect()
    want, drawn = brute_draw(rows, target, percent, 20, buckets, width, 2024)
    assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == sorted(want)
    assert sorted(((r["doc_id"], r["score"], r["rank"]) for r in got if r["rank"]), key=lambda r: r[2]) == drawn


def test_repeated_and_missing_ids_are_drawn_apart(spark):
    text = "word " * 25
    rows = [(7, text)] * 400 + [(None, text)] * 400 + [(i, text) for i in range(100, 120)] + [(1, None), (2, ""), (3, "short")]
    got = resampling.resampled(frame(spark, rows).repartition(4), frame(spark, [(1, None)]), percent=50).collect()
    assert len(got) == len(rows)
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, 411))
    assert all(r["n_features"] == 0 and r["weight"] == 0 and r["rank"] is None for r in got if r["doc_id"] in (1, 2))
    drawn = sorted(((r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got if r["rank"]), key=lambda x: (-x[0], *x[1:]))
    best = sorted(((r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got if r["n_features"] >= 20), key=lambda x: (-x[0], *x[1:]))
    assert drawn == best[:410]


def test_nothing_to_draw(spark):
    docs, goal = frame(spark, [(1, "a b c"), (2, None)]), frame(spark, [(1, "a")])
    assert [r["rank"] for r in resampling.resampled(docs, goal).collect()] == [None, None]
    empty = resampling.resampled(docs.limit(0), goal.limit(0))
    assert empty.columns == ["doc_id", "n_features", "weight", "score", "rank"] and empty.count() == 0


def test_kth_key_of_ties(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 2, 2, None, 9]), rng.randrange(3), i) for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, score long, row long").write.parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows"))
    order = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0, r[2]))
    for k in (1, 2, 167, 400, 500):
        key = resampling.kth_key(table, k)
        assert (key.id, key.score, key.row) == order[k - 1]
    assert resampling.kth_key(table, 501) is None
