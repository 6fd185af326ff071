"""One registered query per operator, over its whole table, and the SQL some are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.alignment import align_tokenizers
from tagloom.llm.chat import format_conversations, read_back
from tagloom.llm.decontaminate import contamination
from tagloom.llm.fertility import quality_rules
from tagloom.llm.html_layout import extract_text
from tagloom.llm.language_id import predict_languages
from tagloom.llm.lm_score import score_texts
from tagloom.llm.manifest import verify_tampered
from tagloom.llm.secrets import scan_secrets
from tagloom.llm.segmentations import encode_decode
from tagloom.llm.set_join import near_duplicates
from tagloom.llm.texts import table
from tagloom.llm.token_counts import count_tokens
from tagloom.llm.warc import archive_pages


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op3_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hits")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def with_control_strings(turns: DataFrame) -> DataFrame:
    """The conversations and one more, -7, whose texts hold control strings."""
    text = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = turns.sparkSession.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(more)


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(format_conversations(with_control_strings(table(spark, sf_dir, "conversations"))))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_tampered(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))


OP3 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), r(doc_id, m) AS (
  SELECT x, y FROM l UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.m = l.x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(f.m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(m) AS m FROM r GROUP BY 1) f USING (doc_id)
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS digest
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# No range, place or file names: those follow the files written, not the pages.
OP9 = """
WITH own AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM own
), digested AS (
  SELECT page_id, payload_bytes, list_aggregate(
    list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS INT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31)::INT, 1)),
    'string_agg', '') AS payload_digest
  FROM hashed
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digested
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM firsts
"""

# The marks of the template and its escape; turns of one conversation follow turn, then role and text.
OP11 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT *, length(regexp_replace(text, '(<)(\\*(?:<SYS>>|</SYS>>|s>|/s>|<ROLE>>|<TEXT>>|</ROLE>>|\|endoftext\|>))|(\[)(\\*/?INST\])', '\1\3_\2\4', 'g'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 25 + length(role) END AS size
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

# CRC-32 bit by bit; levels of a tree as lists, each made from the one below it.
OP12 = r"""
WITH RECURSIVE tampered AS (
  SELECT doc_id, source, lang, n_chars, text,
    CASE WHEN (SELECT xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::BIGINT)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)) % 2 = 0
    THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents
), fields AS (
  SELECT doc_id, source, changed, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM tampered
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS start FROM fields)
), levels(source, level, nodes) AS (
  SELECT source, 0, list(leaf ORDER BY place) FROM leaves GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], ''))) FROM levels WHERE len(nodes) > 1
), subroots AS (
  SELECT source, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM levels WHERE len(nodes) = 1
), tops(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY place) FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], ''))) FROM tops WHERE len(nodes) > 1
), steps AS (
  SELECT source, level, nodes FROM levels WHERE len(nodes) > 1
  UNION ALL SELECT s.source, s.height + t.level, t.nodes FROM subroots s, tops t WHERE len(t.nodes) > 1
), climb AS (
  SELECT doc_id, source, leaf, place, 0 AS level, place AS at, start AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT c.doc_id, c.source, c.leaf, c.place, c.level + 1, p // 3,
    sha256(array_to_string(nodes[p - p % 3 + 1 : p], '') || folded || array_to_string(nodes[p + 2 : p - p % 3 + 3], '')),
    proof || array_to_string(nodes[p - p % 3 + 1 : p], '') || array_to_string(nodes[p + 2 : p - p % 3 + 3], '')
  FROM (
    SELECT c.*, s.nodes, CASE WHEN c.level = u.height THEN u.place ELSE c.at END AS p
    FROM climb c JOIN steps s ON c.source IS NOT DISTINCT FROM s.source AND c.level = s.level JOIN subroots u ON c.source IS NOT DISTINCT FROM u.source
  ) c
), ends AS (
  SELECT *, row_number() OVER (PARTITION BY source, place ORDER BY level DESC) AS r FROM climb
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM ends e JOIN subroots u ON e.source IS NOT DISTINCT FROM u.source, (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1) WHERE r = 1
"""

LLM_QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_lm_score": op2_lm_score,
    "op3_set_join": op3_set_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_secrets": op5_secrets,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_token_counts": op10_token_counts,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

LLM_SQL: dict[str, str] = {
    "op3_set_join": OP3,
    "op8_decontamination": OP8,
    "op9_warc": OP9,
    "op11_chat_formatting": OP11,
    "op12_merkle_manifest": OP12,
}
