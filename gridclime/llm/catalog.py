"""Named queries that apply each operator to its whole table, and SQL that states their results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclime.functions.lineage import stage_folder
from gridclime.llm import (
    exact_mph,
    fair_mix,
    fp_search,
    line_chunks,
    line_runs,
    pieces,
    prefix_trie,
    quality,
    quartile_digest,
    relative_lz,
    shuffle_shards,
    simhash,
    training_order,
    url_rules,
)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_document_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.with_next(table(spark, sf_dir, "documents"))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors, network = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, vectors, network).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


# Lines, their 32-bit hashes and chunks of two or three lines, as minima of rolling hashes make them.
OP3_SQL = f"""
WITH lined AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), each_line AS (
  SELECT doc_id, i, len(lines) AS n, CAST('0x' || substr(md5(lines[i + 1]), 1, 8) AS BIGINT) AS h
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS i FROM lined)
), rolled AS (
  SELECT doc_id, s, i, n, CASE WHEN i + 1 < n THEN (h * a + lead(h) OVER d * b) % {line_chunks.PRIME} ELSE {line_chunks.PRIME} END AS r
  FROM each_line, (VALUES {", ".join(f"({s}, {a}, {b})" for s, (a, b) in enumerate(line_chunks.FACTORS))}) AS t(s, a, b)
  WHERE n > 1 WINDOW d AS (PARTITION BY doc_id, s ORDER BY i)
), cut AS (
  SELECT *, CASE WHEN i BETWEEN 2 AND n - 2 AND r < lag(r) OVER d AND r <= lead(r) OVER d THEN 1 ELSE 0 END AS start
  FROM rolled WINDOW d AS (PARTITION BY doc_id, s ORDER BY i)
), numbered AS (
  SELECT *, sum(start) OVER (PARTITION BY doc_id, s ORDER BY i) AS stretch FROM cut
), parted AS (
  SELECT *, least((i - min(i) OVER g) // 2, count(*) OVER g // 2 - 1) AS part FROM numbered WINDOW g AS (PARTITION BY doc_id, s, stretch)
), chunks AS (
  SELECT DISTINCT doc_id, first, size, lines, array_to_string(lines[first + 1 : first + size], chr(10)) AS body
  FROM (SELECT doc_id, min(i) AS first, count(*) AS size FROM parted GROUP BY doc_id, s, stretch, part) JOIN lined USING (doc_id)
), firsts AS (
  SELECT body, doc_id AS low_id, first AS low, lines AS low_lines FROM chunks
  QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, first) = 1
), met AS (
  SELECT *, first + size AS stop, low + size AS low_stop FROM chunks JOIN firsts USING (body) WHERE (doc_id, first) > (low_id, low)
), grown AS (
  SELECT doc_id, first - coalesce(list_position([first >= k AND low >= k AND lines[first - k + 1] = low_lines[low - k + 1] FOR k IN {list(range(1, line_chunks.REACH + 1))}], FALSE) - 1, {line_chunks.REACH}) AS start,
         stop + coalesce(list_position([coalesce(lines[stop + k] = low_lines[low_stop + k], FALSE) FOR k IN {list(range(1, line_chunks.REACH + 1))}], FALSE) - 1, {line_chunks.REACH}) AS stop
  FROM met
), gone AS (
  SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(start, stop)) AS i FROM grown) GROUP BY doc_id
), counts AS (
  SELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS lines_removed,
       sha256(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10))) AS kept_sha256
FROM documents d LEFT JOIN lined USING (doc_id) LEFT JOIN gone USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_chunks.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col(c).cast("long").alias(c) for c in ("n_lines", "n_chunks", "lines_removed")]
    return found.select("row.doc_id", *counts, F.sha2("kept_text", 256).alias("kept_sha256"))


# Lines in a pair of neighbours that stands at an earlier place go.
OP3_REPEATED_SQL = """
WITH lined AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), each_line AS (
  SELECT doc_id, i, lines[i] AS line, CASE WHEN i < len(lines) THEN lines[i] || chr(10) || lines[i + 1] END AS pair
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM lined)
), judged AS (
  SELECT *, pair IS NOT NULL AND row_number() OVER (PARTITION BY pair ORDER BY doc_id, i) > 1 AS again FROM each_line
), marked AS (
  SELECT *, again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS gone FROM judged
), kept AS (
  SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS lines_removed,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept_text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(lines_removed, 0) AS BIGINT) AS lines_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(k.kept_text) END AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""


@query("op3_repeated_lines", OP3_REPEATED_SQL)
def op3_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.dedup_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col(c).cast("long").alias(c) for c in ("n_lines", "lines_removed")]
    return found.select("row.doc_id", *counts, F.sha2("kept_text", 256).alias("kept_sha256"))


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
OP4_SQL = f"""
WITH lists AS (
  SELECT doc_id, {WORDS_SQL} AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM lists WHERE len(words) >= 13)
), firsts AS (
  SELECT body, min(doc_id) AS first_id FROM windows GROUP BY body
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (body) WHERE doc_id > first_id
), each_word AS (
  SELECT doc_id, p, words[p] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM lists)
), kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS body
  FROM each_word ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM lists LEFT JOIN kept USING (doc_id)
"""


@query("op4_substring_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relative_lz.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_training_order")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of all records, with checksums of what the shards hold."""
    path = f"{stage_folder(spark)}/shards-{uuid.uuid4().hex}"
    index = training_order.write_shards(table(spark, sf_dir, "documents"), path)
    stored = training_order.read_shards(spark, path, tokens=False)
    return index.join(stored, "slot").select("slot", "shard", "record", "byte_offset", "doc_ids", "n_tokens", "tokens_crc32")


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_shards.shard(table(spark, sf_dir, "documents")).drop("row_number")


OP8_SQL = f"""
WITH marked AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{exact_mph.UPPER}', '{exact_mph.LOWER}')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM marked WINDOW g AS (PARTITION BY text_sha256)
"""


@query("op8_exact_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the ids is the history, the upper half the batch that is looked up in it; every row is in one of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((low or 0) + (high or 0)) // 2
    older = F.col("doc_id").isNull() | (F.col("doc_id") <= middle)
    return exact_mph.dedup(docs.where(older), docs.where(~older)).drop("member")


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    decoded = pieces.decode(coded)
    return decoded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.col("piece_ids"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP10_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS shuffle,
         coalesce('s' || source, 'null') AS source_key
  FROM documents
), sources AS (
  SELECT source_key, source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source_key, source
), ratios AS (
  SELECT *, [3, 1, 2][(rank - 1) % 3 + 1] AS weight, 2 * source_size AS cap, sum(source_size) OVER () * 1.5E0 AS budget FROM sources
), levels AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio,
         (budget - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ratios
), goals AS (
  SELECT source_key, source_size, budget, least(CAST(cap AS DOUBLE), weight * coalesce(max(CASE WHEN level <= ratio THEN level END) OVER (), ratio)) AS target
  FROM levels
), queued AS (
  SELECT *, sum(size) OVER (PARTITION BY source_key ORDER BY shuffle, doc_id ROWS UNBOUNDED PRECEDING) AS words
  FROM sized JOIN goals USING (source_key)
), served AS (
  SELECT *, CAST(epoch * source_size + words AS DOUBLE) / target AS finish
  FROM (SELECT *, unnest([0, 1]) AS epoch FROM queued WHERE size > 0)
), cut AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source_key, shuffle, doc_id, epoch ROWS UNBOUNDED PRECEDING) <= budget AS taken
  FROM served
), copies AS (
  SELECT doc_id, sum(CASE WHEN taken THEN size ELSE 0 END) AS taken FROM cut GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN copies USING (doc_id)
"""


@query("op10_source_mixing", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# CRC-32 by its bits: each byte is taken in, then eight steps.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""
OP11_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, CASE WHEN conv_id % 5 = 0 THEN 0 ELSE {CRC_SQL} % 9 END AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS half, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h
), steps AS (
  SELECT conv_id, strlen(text) AS bytes, sha256(strlen(role) || ':' || role || text) AS digest,
         row_number() OVER (PARTITION BY conv_id ORDER BY half, place) AS depth FROM rebuilt
), paths AS (
  SELECT conv_id, depth, bytes, md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM steps
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), placed AS (
  SELECT *, lag(key) OVER c AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths WINDOW c AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT key, min(conv_id) AS conv_id, min(depth) AS depth, min(above) AS above, count(*) AS n_convs, min(bytes) AS bytes,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends) AS list
  FROM placed GROUP BY key
), families AS (
  SELECT above AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above
), subtrees AS (
  SELECT p.key, sum((n.n_convs - 1) * n.bytes) AS saved, count(*) FILTER (WHERE f.key IS NULL) AS leaves
  FROM nodes n LEFT JOIN families f USING (key) JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.key
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.list, '')) AS ends_sha256
FROM nodes n JOIN subtrees s USING (key) LEFT JOIN families f USING (key) LEFT JOIN nodes u ON u.key = n.above
"""


@query("op11_conversation_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


#: The rules of the query.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
OP12_SQL = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), sites AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), rules AS (
  SELECT * FROM (VALUES {", ".join(str(r) for r in URL_RULES)}) AS t(verdict, r_host, r_path)
)
SELECT page_id, host, path,
       (SELECT arg_max(r_host || r_path, (length(r_host || r_path), length(r_host), verdict)) FROM rules
        WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS rule,
       coalesce((SELECT arg_max(verdict, (length(r_host || r_path), length(r_host), verdict)) FROM rules
        WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)), '{url_rules.DEFAULT}') AS verdict
FROM sites
"""


@query("op12_url_filters", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


TERMS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH lists AS (
  SELECT row_number() OVER () AS d, doc_id, terms, len(terms) AS n FROM (SELECT doc_id, {TERMS_SQL} AS terms FROM documents)
), sums AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lists WHERE n > 0
), wanted AS (
  SELECT i, item_id, unnest(list_distinct(terms)) AS term FROM (SELECT row_number() OVER () AS i, item_id, {TERMS_SQL} AS terms FROM benchmark)
), counts AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM lists) GROUP BY d, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0E0 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, sums WHERE term IN (SELECT term FROM wanted) GROUP BY term
), parts AS (
  SELECT d, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * s.docs) // s.terms))) AS part
  FROM counts JOIN weights USING (term) JOIN lists USING (d), sums s
), scores AS (
  SELECT i, item_id, d, CAST(sum(part) AS BIGINT) AS score FROM wanted JOIN parts USING (term) GROUP BY i, item_id, d HAVING sum(part) > 0
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores JOIN lists USING (d)
WINDOW best AS (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER best <= {fp_search.TOP}
"""


@query("op13_lexical_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
