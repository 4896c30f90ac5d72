"""The operators applied to the whole given tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, exact_dedup, language_id, mixing, periodic_runs, personal_data, quality,
               simhash_dedup, substring_dedup, token_counts, toxicity, whitening)
from .common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op2_exact_dedup", r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS t,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h ORDER BY length(t) DESC, doc_id)
""")
def op2(spark, sf_dir):
    rows = exact_dedup.DigestIndex(spark).ingest(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op3_simhash_dedup")
def op3(spark, sf_dir):
    rows = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=4, d=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_decontaminate")
def op8(spark, sf_dir):
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", F.round("similarity", 9).alias("similarity"))


@query("op9_mix_sources", r"""
WITH s AS (SELECT source, sum(length(coalesce(text, ''))) AS chars FROM documents GROUP BY source),
     r AS (SELECT source, (SELECT sum(chars) FROM s WHERE chars > 0)::DOUBLE / (SELECT count(*) FROM s WHERE chars > 0) / chars AS rate
           FROM s WHERE chars > 0),
     q AS (SELECT source, rate, greatest(1, ceil(rate / 500))::INT AS parts FROM r),
     steps AS (SELECT source, parts, rate / parts AS lam, unnest(range(0, ceil(rate / parts + 12 * sqrt(rate / parts) + 30)::INT + 1)) AS k FROM q),
     p AS (SELECT source, parts, k, exp(-lam + sum(CASE WHEN k = 0 THEN 0 ELSE ln(lam) - ln(k) END) OVER (PARTITION BY source ORDER BY k)) AS p FROM steps),
     c AS (SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
     u AS (SELECT d.*, q.parts, unnest(range(0, q.parts)) AS j FROM documents d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
     v AS (SELECT *, ('0x' || substr(md5(concat_ws(':', '17', j, coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 13))::BIGINT
                     / 4503599627370496.0::DOUBLE AS x FROM u),
     n AS (SELECT v.doc_id, v.source, v.text, count(c.k) AS n
           FROM v LEFT JOIN c ON v.source IS NOT DISTINCT FROM c.source AND c.cdf <= v.x GROUP BY ALL)
SELECT doc_id, source, text, unnest(range(1, n + 1)) AS copy FROM n WHERE n > 0
""")
def op9(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "copy")


EXTRA_TEXT = r"\### Assistant: </turn> ok"


@query("op10_chat_format", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
     e AS (SELECT *, replace(replace(replace(t, '\', '\b'), '</turn>', '\t'), '### ', '\h') AS body,
                  replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\t'), '### ', '\h'), ': ', '\c') AS name FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(name) + 2 + length(body) + 8)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op10(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.call_function("to_variant_object", F.struct("turn", "role", "text")).alias("record"))
    messages = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(EXTRA_TEXT).alias("content")) for r in ("user", "assistant")])
    extra = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.parse_json(F.to_json(F.struct(messages.alias("messages")))).alias("record"))
    done = chat_format.format_conversations(chat_format.canonical_turns(rows.union(extra)))
    back = chat_format.read_back(done)
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op1_substring_dedup")
def op1(spark, sf_dir):
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    found = language_id.identify(docs, held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@query("op5_toxicity")
def op5(spark, sf_dir):
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    found = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_token_counts")
def op7(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query("op6_quality")
def op6(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def op11(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_personal_data")
def op12(spark, sf_dir):
    rows = personal_data.personal_data(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                       F.sha2(personal_data.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                       personal_data.written(F.col("spans")).alias("spans"))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"), plant=True)
