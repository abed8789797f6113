"""One query per operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import quality, toxicity
from .balltree import rank_documents
from .bpe import encode_decode
from .chat import digest_chat, format_chat
from .decontam import contaminated
from .fmindex import remove_repeated_words, words_joined
from .common import cut_lineage
from .html import extract
from .periodic import find_runs
from .pii import find_personal_data, listed
from .simhash import hex_bits, near_duplicates
from .suffix import remove_repeated_bytes
from .warc import archive_and_read

# Where the vocabulary files of public tokenizers are
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def removed(spans: str):
    """Units inside the intervals of a flat list of begins and ends."""
    return F.expr(f"aggregate(sequence(0, greatest(size({spans}), 1) - 1), 0L, "
                  f"(s, i) -> s + coalesce(if(i % 2 = 0, -1L, 1L) * get({spans}, i), 0L))")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cut_lineage(quality.statistics(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return quality.judged(stats, quality.learn(stats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_bytes(docs).select(
        "doc_id", "n_bytes", removed("spans").alias("n_removed"),
        F.expr("cast(size(spans) div 2 as bigint)").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "coverage", F.size("tiles").cast("bigint").alias("n_tiles"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, network).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_words(docs).select(
        "doc_id", "n_words", removed("spans").alias("n_removed"),
        F.sha2(words_joined(F.col("kept")), 256).alias("kept_sha256"))


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, f"{TOKENIZERS}/word_bpe_49k.json").select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", hex_bits(F.col("fingerprint_bits")).alias("fingerprint"), "component_id")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') "
                      "AS t(conv_id, turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return digest_chat(format_chat(turns))


def planted_period(doc_id: str = "doc_id", text: str = "text"):
    """Every tenth text by checksum of its id goes on repeating its own words from some
    place on; all others, and those without words, stay as they are."""
    words = f"regexp_extract_all({text}, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    return F.expr(f"""
        case when crc32(cast({doc_id} as string)) % 10 = 0 and size({words}) > 0 then
          array_join(transform(array(named_struct('w', {words}, 'g', crc32(cast({doc_id} as string)) div 10)), t ->
            array_join(transform(array(named_struct('a', t.g % size(t.w),
                                                    'p', 1 + (size(t.w) - t.g % size(t.w)) div (3 + t.g % 8))), s ->
              array_join(transform(sequence(0, size(t.w) - 1), i ->
                get(t.w, cast(if(i < s.a, i, s.a + (i - s.a) % s.p) as int))), ' ')), '')), '')
        else {text} end""")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_period().alias("text"))
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    return find_runs(docs).withColumn("best", best).select(
        "doc_id", F.expr("cast(size(runs) as bigint)").alias("n_runs"), F.expr("-best.start").alias("start"),
        F.col("best.length").alias("length"), F.expr("-best.period").alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.expr(r"sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), ''), 256)")
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *(F.expr(f"cast(size(filter(spans, s -> s.base and s.kind = '{kind}')) as bigint) as n_{kind}")
                    for kind in ("email", "ip", "card", "phone")),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc": op2_warc,
    "op3_html_extraction": op3_html_extraction,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe_encoding": op8_bpe_encoding,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_pii": op12_pii,
    "op13_ranked_search": op13_ranked_search,
}

SQL = {
    "op13_ranked_search": r"""
WITH q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), sizes AS (
  SELECT count(*) AS all_docs, cast(sum(len(terms)) AS bigint) AS all_terms FROM d WHERE len(terms) > 0
), t AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, cast(floor(1000 * ln(cast(2 * any_value(all_docs) + 2 AS double) / cast(2 * count(*) + 1 AS double))) AS bigint) AS weight
  FROM t, sizes GROUP BY term
), s AS (
  SELECT item_id, doc_id, cast(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms))))
                               AS bigint) AS score
  FROM q JOIN t USING (term) JOIN w USING (term), sizes GROUP BY item_id, doc_id
)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 20""",
    "op2_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f""",
    "op10_chat_formatting": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(8 + length(role) + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))) AS bigint) AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op7_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY s) > 1), unnest(range(35)) AS r(k)
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS text
  FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, cast(len(ws) AS bigint) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
}
