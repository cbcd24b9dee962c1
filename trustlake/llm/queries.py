"""The operators over their whole tables, with the SQL that must give the same rows where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trustlake.llm.contamination import contained_items
from trustlake.llm.conversation_trie import conversation_trie
from trustlake.llm.exact_dedup import classify
from trustlake.llm.filter_audit import audit_filters
from trustlake.llm.html_text import extract_pages
from trustlake.llm.licenses import scan_licenses
from trustlake.llm.packing import pack
from trustlake.llm.quality import classify_quality, fit
from trustlake.llm.quality_rules import judge_documents
from trustlake.llm.secrets_scan import scan_secrets
from trustlake.llm.simhash import near_groups
from trustlake.llm.token_counts import count_tokens
from trustlake.llm.token_files import read_digests, write_token_files
from trustlake.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL if there is one."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query("op1_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


@query("op2_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify_quality(docs, fit(docs, table(spark, sf_dir, "labels")))


@query("op3_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def plain_words_sql(text: str) -> str:
    """SQL of the words of a text: runs of digits, ASCII letters (lower-cased) and non-ASCII characters."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


CONTAINED_ITEMS = f"""
WITH items AS (SELECT DISTINCT item_id, {plain_words_sql("text")} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS width,
         unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2),
                               lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) AS shingle
  FROM items WHERE len(w) > 0),
docs AS (SELECT doc_id, {plain_words_sql("text")} AS w FROM documents),
held AS (
  SELECT DISTINCT doc_id, width,
         unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS shingle
  FROM docs, (SELECT DISTINCT width FROM wanted)),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM wanted GROUP BY item_id),
met AS (SELECT doc_id, item_id, count(*) AS matched FROM wanted JOIN held USING (width, shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, matched, matched / item_shingles AS containment
FROM met JOIN sizes USING (item_id) WHERE 10 * matched >= 8 * item_shingles"""


@query("op4_benchmark_decontamination", CONTAINED_ITEMS)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "tokens")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer)
    return read_digests(manifest, folder)


@query("op6_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


@query("op7_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op8_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


@query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


EXACT_COPIES = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
       rank() OVER best = 1 AS kept, sha256(content) AS text_sha256
FROM rows WINDOW best AS (PARTITION BY content ORDER BY n DESC, doc_id)"""


@query("op10_exact_dedup", EXACT_COPIES)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))


FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
stated AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT t.part, coalesce(s.good, 0) AS good, coalesce(s.toxic, 0) AS toxic,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda f:
           (f = 'A' AND len(w) < 200) OR (f = 'B' AND 100 * len(list_distinct(w)) < 50 * len(w))
           OR (f = 'C' AND 100 * len(regexp_replace(t.text, '[^A-Z]+', '', 'g')) > 2 * len(t.text))
           OR (f = 'D' AND regexp_matches(t.text, '[#$%&*|]')) OR (f = 'E' AND coalesce(t.doc_id > first_id, false))) AS fails
  FROM texts t JOIN first USING (text) LEFT JOIN stated s USING (doc_id)),
combos AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS own, string_split(left(filter_order, step::INT - 1), '') AS earlier
  FROM orders, range(1, 6) AS s(step)),
counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN list_contains(fails, own) AND list_has_any(fails, earlier) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = [own] THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN toxic ELSE 0 END) AS toxic_lost
  FROM combos, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted"""


@query("op11_filter_audit", FILTER_AUDIT)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


CONVERSATION_TRIE = r"""
WITH RECURSIVE bits(code, value, step) AS (
  SELECT code, code, 0 FROM range(256) AS b(code)
  UNION ALL SELECT code, CASE WHEN value % 2 = 1 THEN xor(value // 2, 3988292384) ELSE value // 2 END, step + 1 FROM bits WHERE step < 8),
crc_table AS (SELECT list(value ORDER BY code) AS entries FROM bits WHERE step = 8),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS head, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, code: xor(crc // 256, entries[xor(crc % 256, code) + 1]))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc_table),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) - 1 AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, place, role, text FROM convs c JOIN placed p ON p.conv_id = c.head AND place < h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND place >= h),
turns AS (
  SELECT conv_id, row_number() OVER turns AS depth, strlen(text) AS size,
         sha256(string_agg(sha256(role) || sha256(text), '') OVER turns) AS node
  FROM rebuilt WINDOW turns AS (PARTITION BY conv_id ORDER BY own, place)),
path AS (SELECT * FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
steps AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
                 max(depth) OVER (PARTITION BY conv_id) AS length FROM path),
nodes AS (
  SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
         (count(*) - 1) * any_value(size) AS saved, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length) AS ends
  FROM steps GROUP BY node),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.parent = n.node),
totals AS (
  SELECT above.node, count(*) FILTER (low.n_children = 0) AS n_leaves, sum(low.saved) AS saved_tokens
  FROM full_nodes low JOIN steps above ON above.conv_id = low.conv_id AND above.depth <= low.depth GROUP BY above.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM full_nodes n JOIN totals t USING (node) LEFT JOIN nodes p ON p.node = n.parent"""


@query("op12_conversation_trie", CONVERSATION_TRIE)
def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op13_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"))
