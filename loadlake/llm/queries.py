"""The queries of this subpackage and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake.llm import (
    embeddings,
    exact_dedup,
    html_text,
    language_id,
    licenses,
    mixing,
    packing,
    periodic_runs,
    resampling,
    sentencepieces,
    simhash,
    substrings,
    toxicity,
)
from loadlake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def query(run: Query) -> Query:
    _queries[run.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracle)


def pieces_packed(docs: DataFrame) -> DataFrame:
    """Where each piece of ``docs`` goes, with the checksum of its ids in their place."""
    rows = packing.pieces(docs, "byte_bpe_50k.json")
    return packing.packed(rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_packed(table(spark, sf_dir, "documents"))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), seed=17, power=0.5)


_oracle["op4_mixing"] = """
WITH RECURSIVE counts AS (SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source),
rates AS (
  SELECT source, CAST((SELECT sum(n) FROM counts) AS DOUBLE) * weight / (SELECT sum(weight) FROM counts) / n AS rate
  FROM counts),
parts AS (
  SELECT source, rate, CAST(greatest(ceil(rate / 64.0), 1) AS BIGINT) AS parts, rate / greatest(ceil(rate / 64.0), 1) AS mean FROM rates),
terms AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM parts
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM terms
  WHERE k < ceil(mean + 10 * sqrt(mean) + 20)),
drawn AS (
  SELECT d.doc_id, d.source, part,
         CAST(('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || part), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d JOIN parts p ON p.source IS NOT DISTINCT FROM d.source, LATERAL (SELECT unnest(generate_series(1, p.parts)) AS part)),
numbers AS (
  SELECT doc_id, count(*) FILTER (WHERE u >= c) AS n
  FROM drawn JOIN terms ON terms.source IS NOT DISTINCT FROM drawn.source GROUP BY doc_id)
SELECT d.*, CAST(unnest(generate_series(1, n)) AS INTEGER) AS copy FROM documents d JOIN numbers USING (doc_id)
"""


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digests=True)


_oracle["op7_exact_dedup"] = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
best AS (
  SELECT text_sha256, count(*) AS group_size,
         first(doc_id ORDER BY points DESC, doc_id) AS keep_id
  FROM normal GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM normal JOIN best USING (text_sha256)
"""


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substrings.repeated_passages(docs, window=50, with_text=False).drop("kept_text")


_oracle["op10_substring_dedup"] = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS sequence
  FROM (SELECT *, unnest(generate_series(1, len(words) - 49)) AS i FROM split WHERE len(words) >= 50)),
known AS (SELECT sequence, min(doc_id) AS first FROM windows GROUP BY sequence HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS at
  FROM windows JOIN known USING (sequence) WHERE first < doc_id),
listed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS at FROM split),
kept AS (
  SELECT l.doc_id, string_agg(word, ' ' ORDER BY l.at) FILTER (WHERE g.at IS NULL) AS text, count(g.at) AS n_removed
  FROM listed l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.at = l.at GROUP BY l.doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split LEFT JOIN kept k USING (doc_id)
"""


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


_oracle["op8_embedding_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
named AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM named
"""


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.predicted(docs, model).withColumn("held_out", language_id.held_out())


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def license_sql() -> str:
    """The same scan in SQL, with the tables of sentences and rules as values."""
    known = ", ".join(f"('{name}', '{sentence}')" for name, sentence in licenses.SENTENCES.items())
    rules = ["".join(f"<{i}>" for i in sequence) for _, sequence in licenses.RULES]
    named = ", ".join(f"('{rule}', '{licence}')" for rule, (licence, _) in zip(rules, licenses.RULES, strict=True))

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"

    def replaced(value: str, pairs: list[tuple[str, str]]) -> str:
        for pattern, replacement in pairs:
            value = f"regexp_replace({value}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
        return value

    plain = replaced("trim(regexp_replace(lower(piece), '[^a-z0-9]+', ' ', 'g'))", licenses.VARIANTS)
    return rf"""
WITH known(name, sentence) AS (VALUES {known}), named(rule, licence) AS (VALUES {named}),
sentences AS (
  SELECT doc_id, place, piece, {plain} AS plain
  FROM (SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS piece
        FROM (SELECT doc_id, string_split_regex({replaced("text", licenses.PREPARED)}, {quoted(licenses.BOUNDARY)}) AS parts FROM documents))
  WHERE regexp_matches(piece, '[A-Za-z0-9][A-Za-z0-9]')),
whole AS (SELECT s.*, k.name FROM sentences s LEFT JOIN known k ON k.sentence = s.plain),
lines AS (
  SELECT doc_id, place, line, {plain} AS plain
  FROM (SELECT doc_id, place, generate_subscripts(parts, 1) AS line, unnest(parts) AS piece
        FROM (SELECT doc_id, place, string_split(piece, chr(10)) AS parts FROM whole WHERE name IS NULL))
  WHERE regexp_matches(piece, '[A-Za-z0-9][A-Za-z0-9]')),
told AS (
  SELECT doc_id, place, 0 AS line, name FROM whole WHERE name IS NOT NULL
  UNION ALL SELECT doc_id, place, line, name FROM lines LEFT JOIN known ON sentence = plain),
sequences AS (
  SELECT doc_id, count(*) AS n_sentences, count(name) AS n_known,
         string_agg('<' || coalesce(name, '-') || '>', '' ORDER BY place, line) AS sequence
  FROM told GROUP BY doc_id),
matches AS (
  SELECT doc_id, generate_subscripts(rules, 1) AS place, unnest(rules) AS rule
  FROM (SELECT doc_id, regexp_extract_all(sequence, '{"|".join(rules)}') AS rules FROM sequences)),
found AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licenses, string_agg(rule, ' ' ORDER BY place) AS matched
  FROM matches JOIN named USING (rule) GROUP BY doc_id)
SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_known, 0) AS n_known,
       coalesce(licenses, '') AS licenses, coalesce(matched, '') AS matched
FROM documents LEFT JOIN sequences USING (doc_id) LEFT JOIN found USING (doc_id)
"""


_oracle["op5_license_scan"] = license_sql()


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~language_id.held_out()).select("doc_id", "toxic"))
    return toxicity.scored(docs, model).withColumn("held_out", language_id.held_out())


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes in SQL, bit by bit."""
    octets = f"list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)"
    bit = "lambda r, k: CASE WHEN r & 1 = 1 THEN xor(3988292384::BIGINT, r >> 1) ELSE r >> 1 END"
    step = f"lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), {bit})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295::BIGINT)"


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic_runs.made_periodic(F.col("text"), F.col("doc_id")).alias("text"))
    rows = periodic_runs.periodic_runs(docs, min_length=24, min_exponent=3)
    best = periodic_runs.longest(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000).cast("long") * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_oracle["op11_periodic_runs"] = rf"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents),
shaped AS (
  SELECT doc_id, words, h % 10 = 0 AND len(words) > 0 AS again, (h // 10) % greatest(len(words), 1) AS a,
         1 + (len(words) - (h // 10) % greatest(len(words), 1)) // (3 + (h // 10) % 8) AS p
  FROM split),
listed AS (
  SELECT doc_id, i, CASE WHEN again AND i >= a THEN words[a + (i - a) % p + 1] ELSE words[i + 1] END AS w
  FROM (SELECT *, unnest(range(len(words))) AS i FROM shaped)),
equal AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM listed x JOIN listed y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
best AS (
  SELECT r.* FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (o.length * r.period > r.length * o.period
      OR (o.length * r.period = r.length * o.period AND (o.start, o.period) < (r.start, r.period))))),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT l.doc_id, string_agg(w, ' ' ORDER BY l.i) AS text
  FROM listed l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, b.length * 1000 // b.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query
def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = "piece_bpe_32k.model"
    rows = sentencepieces.decoded(sentencepieces.encoded(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resampled(docs, target, percent=10, min_words=20, buckets=10_000, width=1, seed=2024)


_oracle["op13_resampling"] = rf"""
WITH listed AS (
  SELECT doc_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
targeted AS (
  SELECT unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
counted AS (SELECT w, count(*) AS s FROM listed WHERE w <> '' GROUP BY w),
wanted AS (SELECT w, count(*) AS t FROM targeted WHERE w <> '' GROUP BY w),
words AS (
  SELECT w, coalesce(s, 0) AS s, coalesce(t, 0) AS t, {crc32_sql("w")} % 10000 AS bucket FROM counted FULL JOIN wanted USING (w)),
totals AS (SELECT sum(s) AS s, sum(t) AS t FROM words),
gains AS (
  SELECT bucket, floor(1000 * ln((sum(words.t) + 1)::DOUBLE * (any_value(totals.s) + 10000)::DOUBLE
                                 / ((sum(words.s) + 1)::DOUBLE * (any_value(totals.t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM words, totals GROUP BY bucket),
weights AS (
  SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM listed JOIN words USING (w) JOIN gains USING (bucket) WHERE w <> '' GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
         + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed USING (doc_id)
"""
