"""The operators' queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontaminate, forest, langid, licences, mixing, quality, sharding, simhash, tokens, trie, warc
from .util import table, text_or_empty

#: Where a vocabulary file of a public tokenizer lies (the environment may name another), and how its texts are split; both are parameters of op9.
VOCABULARY = os.environ.get("ROLODECK_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of each document."""
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one more that speaks in control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    conversations = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(more)
    return chat.conversation_digests(chat.format_conversations(conversations))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to packages of WARC records and read back."""
    manifest = warc.write_packages(table(spark, sf_dir, "pages"))
    return warc.read_packages(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of each document."""
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join(F.array_sort("licences"), ",").alias("licences"), "unmatched")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each document, and the verdict by base rules and certified cutoffs."""
    found = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document among 16 shards; counts differ by one at most."""
    text = text_or_empty(F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.shard(rows, 16, content=F.xxhash64("text_crc32", "size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = mixing.plan_mix(docs, weights=[5, 2, 1], budget=1.5, most=2).documents
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep_text=False)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, counted in flat token files."""
    return tokens.document_tokens(table(spark, sf_dir, "documents"), tokens.load_vocabulary(VOCABULARY), SPLIT)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document; what is held out was not learnt from. A document without an id is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    model = langid.train(docs.filter(~held_out))
    return langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model, keep_text=False)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of each fiftieth."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations' prefixes."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("ref_conv_id", "ref_place")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_simhash, op2_chat, op3_warc, op4_licence_scan, op5_quality, op6_sharding, op7_mixing, op8_decontamination, op9_token_counts, op10_language, op11_collocations, op12_neighbours, op13_prefix_trie, pipeline)
    return {f.__name__: f for f in own}


OP2_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '([<\[])(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|TURN\]|ROLE\]|/TURN\])', '\1\\\2', 'g') AS escaped FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 19 + length(coalesce(role, '')) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

OP3_SQL = """
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
  CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)"""

# The ladder and signals are quality's; alpha 0.01, delta 0.05 over the strata.
OP5_SQL = rf"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, lang, t, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims FROM w
), win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i : i + 7], ' ')) AS c FROM w, unnest(generate_series(1, len(w) - 7)) u(i) WHERE len(w) >= 8
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM win, unnest(generate_series(i, i + 7)) u(p) WHERE c > 1 GROUP BY doc_id
), g AS (
  SELECT f.doc_id, lang, t, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    greatest(coalesce(n_symbols::DOUBLE / nullif(n_words, 0) / {quality.SIGNALS["symbols per word"]}, 0), coalesce(n_exclaims::DOUBLE / nullif(n_words, 0) / {quality.SIGNALS["exclamation marks per word"]}, 0), coalesce(n_upper::DOUBLE / nullif(n_letters, 0) / {quality.SIGNALS["capitals among letters"]}, 0), coalesce((len(lines) - len(list_distinct(lines)))::DOUBLE / nullif(len(lines), 0) / {quality.SIGNALS["repeated lines"]}, 0)) AS signal
  FROM f LEFT JOIN rep ON f.doc_id = rep.doc_id
), s AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, coalesce(len(list_filter({list(quality.LADDER)}::DOUBLE[], lambda x: 1.0::DOUBLE / nullif(signal, 0) > x)), {len(quality.LADDER)}) AS step FROM g
), h AS (
  SELECT lang, max(quality) AS quality, min(CASE WHEN signal = 0 THEN {len(quality.LADDER)} ELSE step END) AS step FROM s JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IN (0, 1) GROUP BY lang, t
), l AS (
  SELECT a.lang, b.step, count(*) FILTER (quality = 1 AND h.step <= b.step) AS rejected, count(*) FILTER (quality = 0 AND h.step <= b.step) AS caught, count(*) FILTER (quality = 1) AS n
  FROM (SELECT DISTINCT lang FROM h) a, range({len(quality.LADDER)}) b(step) JOIN h ON h.lang IS NOT DISTINCT FROM a.lang GROUP BY 1, 2
), p AS (
  SELECT *, CASE WHEN n = 0 OR rejected >= n THEN 1.0 ELSE list_sum(list_transform(range(0, rejected + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) END > 0.05 / (SELECT count(DISTINCT coalesce(lang, chr(1))) FROM h) AS fails FROM l
), r AS (
  SELECT *, bool_or(fails) OVER (PARTITION BY lang ORDER BY step) AS failed FROM p
), k AS (
  SELECT lang, arg_min(step, [rejected - caught, step]) AS cut FROM r WHERE NOT failed AND caught > rejected GROUP BY lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(CASE WHEN signal > 0 THEN step END <= cut, false) AS kept
FROM s LEFT JOIN k ON s.lang IS NOT DISTINCT FROM k.lang"""

OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('mix-0:' || doc_id) AS digest FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM d GROUP BY source
), r AS (
  SELECT *, 2.0 * source_size::DOUBLE AS cap, 2.0 * source_size::DOUBLE / weight AS ratio, (SELECT sum(size) FROM d)::DOUBLE AS total, sum(weight) OVER () AS weights FROM s
), l AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * total - coalesce(sum(cap) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0)) AS level
  FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap, weight * (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1)) AS target FROM l
), q AS (
  SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, pass, (before + pass * source_size)::DOUBLE / target AS finish FROM q, (VALUES (0), (1)) p(pass) WHERE size > 0
), o AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, digest, doc_id) AS so_far FROM e
), k AS (
  SELECT doc_id, sum(size) AS taken FROM o WHERE so_far <= 1.5 * (SELECT sum(size) FROM d) GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN k USING (doc_id)"""

OP8_SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), bw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
  FROM bw, unnest(generate_series(1, greatest(1, len(w) - 12))) u(i) WHERE len(w) > 0
), dwin AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM dw, (SELECT DISTINCT n FROM win) l, unnest(generate_series(1, len(w) - n + 1)) u(i) WHERE len(w) >= n
), m AS (
  SELECT doc_id, i, dwin.n, item_id FROM dwin JOIN win USING (n, s)
), h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM m, unnest(generate_series(i, i + n - 1)) u(p) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)"""

OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, n, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM w, (VALUES (1), (2), (3), (4)) l(n), unnest(generate_series(1, len(w) - n + 1)) u(i) WHERE len(w) >= n
), f AS (
  SELECT lang, n, phrase, count(*) AS a FROM g GROUP BY 1, 2, 3
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE n > 1 AND a >= 30
), k AS (
  SELECT c.lang, c.phrase, c.n, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
  FROM c, unnest(generate_series(1, c.n - 1)) u(k)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 :], ' ')
), b AS (
  SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), x AS (
  SELECT DISTINCT b.lang, b.phrase FROM b JOIN c ON c.lang = b.lang AND c.n > b.n AND (' ' || c.phrase || ' ') LIKE '%' || ' ' || replace(replace(replace(b.phrase, '!', '!!'), '%', '!%'), '_', '!_') || ' ' || '%' ESCAPE '!' WHERE 100::HUGEINT * c.a >= 80::HUGEINT * b.a
), t AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b ANTI JOIN x ON x.lang = b.lang AND x.phrase = b.phrase
)
SELECT t.lang, rank, phrase, a, l, r, s.n, CAST(score AS BIGINT) AS score
FROM t JOIN (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE n = 1 GROUP BY lang) s ON s.lang = t.lang WHERE rank <= 2000"""

# A path is the hex digests of its turns, one after the other.
OP13_SQL = r"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i))
), t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS base, count(*) AS n, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT) AS codes FROM t GROUP BY conv_id
), v AS (
  SELECT c, base, n, xor(4294967295, list_reduce(list_prepend(4294967295, codes), lambda a, b: xor(a // 256, tab[1 + xor(a, b) % 256]))) % 6 AS h FROM s, tab
), g AS (
  SELECT v.*, least(h, coalesce(b.n, 0)) AS given FROM v LEFT JOIN (SELECT c AS base_, n FROM s) b ON b.base_ = v.base
), r AS (
  SELECT c, place + 1 AS depth, role, text FROM g JOIN t ON t.conv_id = g.base AND place < h
  UNION ALL SELECT c, place - h + given + 1, role, text FROM g JOIN t ON t.conv_id = g.c AND place >= h
), p AS (
  SELECT c, depth, text, string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY depth) AS path FROM r
  UNION ALL SELECT c, 0, '', '' FROM g
), node AS (
  SELECT path, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(length(text)) AS saved FROM p GROUP BY path
), up AS (
  SELECT *, CASE WHEN depth > 0 THEN left(path, length(path) - 64) END AS above FROM node
), kids AS (
  SELECT above, count(*) AS n FROM up WHERE above IS NOT NULL GROUP BY above
), leafy AS (
  SELECT up.*, coalesce(kids.n, 0) AS n_children FROM up LEFT JOIN kids ON kids.above = up.path
), ends AS (
  SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest FROM (SELECT c, arg_max(path, depth) AS path FROM p GROUP BY c) GROUP BY path
), sums AS (
  SELECT a.path, CAST(count(*) FILTER (b.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens FROM leafy a JOIN leafy b ON starts_with(b.path, a.path) GROUP BY a.path
)
SELECT l.conv_id, CAST(l.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, l.n_convs, l.n_children, n_leaves, saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM leafy l JOIN sums ON sums.path = l.path LEFT JOIN node q ON q.path = l.above LEFT JOIN ends ON ends.path = l.path"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": OP2_SQL, "op3_warc": OP3_SQL, "op4_licence_scan": licences.oracle(), "op5_quality": OP5_SQL, "op7_mixing": OP7_SQL, "op8_decontamination": OP8_SQL, "op11_collocations": OP11_SQL, "op13_prefix_trie": OP13_SQL}
