"""The registered queries of this package and, where SQL can say it, their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    compact_windows,
    decontamination,
    merkle,
    minhash,
    packing,
    periodic_runs,
    pitman_yor,
    preference,
    quality_ledger,
    rans,
    simhash,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(of: int, remainder: int, doc_id: str = "doc_id"):
    """Whether crc32 of the id, as text, leaves this remainder."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % of == remainder, F.lit(False))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


OP8 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
),
m AS (
  SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, row_number() OVER () AS r, w
  FROM d
),
windows AS (
  SELECT r, i, list_slice(w, i, i + 2) AS x FROM (SELECT r, w, unnest(range(1, n_words - 1)) AS i FROM m)
),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
),
ledger AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM m LEFT JOIN covered USING (r)
)
SELECT *,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (word_chars < 2 * n_words)::INT + 16 * (word_chars > 20 * n_words)::INT
    + 32 * (10 * n_dup_lines > 3 * n_lines)::INT AS BIGINT) AS failed_bits,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM ledger
"""


@query("op8_quality_ledger", OP8)
def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ledger.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    judged = quality_ledger.verdict(quality_ledger.verdict(rows), quality_ledger.BASE, "__base")
    return judged.withColumn("base_failed", ~F.col("__base")).select(
        "doc_id", *quality_ledger.MEASURES, "base_failed", "failed_bits", "kept"
    )


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_rans_tokens")
def op9_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.through_file(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


OP6 = r"""
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
a AS (
  SELECT conv_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') AS k FROM c
),
p AS (
  SELECT conv_id, t[:k[-1] - 1] AS head, t[k[-1]] AS good, t[k[-2]] AS bad FROM a WHERE len(k) >= 2
),
r AS (
  SELECT *, array_to_string(list_transform(head, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10) || '<|end|>' || chr(10)), '') AS h,
    '<|assistant|>' || chr(10) || good.text || chr(10) || '<|end|>' || chr(10) AS g,
    '<|assistant|>' || chr(10) || bad.text || chr(10) || '<|end|>' || chr(10) AS b
  FROM p
)
SELECT conv_id AS pair_id, CAST(len(head) + (good = bad)::INT AS BIGINT) AS n_prompt,
  CASE WHEN good = bad THEN h || g ELSE h END AS prompt,
  CASE WHEN good = bad THEN '' ELSE g END AS chosen, CASE WHEN good = bad THEN '' ELSE b END AS rejected,
  CASE WHEN good = bad THEN '' ELSE '14-' || len(g) END AS chosen_learned,
  CASE WHEN good = bad THEN '' ELSE '14-' || len(b) END AS rejected_learned
FROM r
"""


@query("op6_preference", OP6)
def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = preference.conversations(table(spark, sf_dir, "conversations"))
    rows = preference.preference_rows(preference.stale_replies(held))
    spans = "array_join(transform({0}, s -> concat(s.from, '-', s.to)), ',')"
    return rows.withColumns({c: F.expr(spans.format(c)) for c in ("chosen_learned", "rejected_learned")})


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op10_warc", OP10)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.through_archive(table(spark, sf_dir, "pages")).drop("url")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(4, 2)
    model = toxicity.fit(toxicity.labelled_texts(docs, table(spark, sf_dir, "labels"), out))
    rows = toxicity.score(docs, model).withColumn("held_out", out)
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int")).select("doc_id", "held_out", "score", "predicted")


@query("op5_pitman_yor")
def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"), held_out(10, 0))


@query("op2_compact_windows")
def op2_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compact_windows.classes(compact_windows.repeated_passages(docs), docs)


@query("op11_minhash")
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op12_merkle")
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    tampered = merkle.leaf([changed.get(c, F.col(c)) for c in columns])
    carry = {"held": F.when(held_out(2, 0), tampered)}
    rows = merkle.manifest(table(spark, sf_dir, "documents"), columns, carry=carry)
    proved = rows.withColumns(
        {
            "proof_sha256": F.sha2(merkle.proof_text(F.col("left"), F.col("right")), 256),
            "folded_root": merkle.folded(F.coalesce("held", "leaf"), F.col("left"), F.col("right")),
        }
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth crc32 of a doc_id, the words from some place on repeat with some period."""
    # The words are bound once; a lambda would evaluate the expression per word.
    cut = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
    repeated = f"""transform(array({cut}), w -> transform(array(named_struct('a', int(g % size(w)), 'n', size(w))), s ->
        array_join(transform(sequence(0, s.n - 1), i ->
            w[if(i < s.a, i, s.a + (i - s.a) % int(1 + floor((s.n - s.a) / (3 + g % 8))))]), ' '))[0])[0]"""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    chosen = (F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return rows.select("doc_id", F.when(chosen, F.expr(repeated)).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_period(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS before, -r.period AS fast)))")
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.fast")).alias("period"),
        F.floor(F.col("top.length") * 1000 / -F.col("top.fast")).cast("long").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
