"""One registered query per operator, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return add


@registered("op2_line_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.quality import verdicts

    return verdicts(table(spark, sf_dir, "documents"))


@registered("op8_entropy_mix")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.mixing import balance

    return balance(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@registered("op5_addressable_codes")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.common import fresh_path
    from telescry.llm.dac import read_tokens, write_tokens

    path = fresh_path(spark, "token-codes")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return read_tokens(spark, path).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@registered("op6_square_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.packing import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@registered("op1_parity_sketch_join", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS sizes, count(*) AS common FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 85 * (sizes - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a)
SELECT doc_id, len(s) AS n_shingles, (SELECT min(b) FROM reached WHERE a = doc_id) AS component_id FROM sets
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.ngram_join import Likeness, similarity_components

    return similarity_components(table(spark, sf_dir, "documents"), Likeness(width=4, percent=85))


@registered("op3_path_ratios")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


@registered("op7_toxic_grammar")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.toxicity import learn, score_texts

    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, learn(docs, table(spark, sf_dir, "labels")))


@registered("op4_bootstrapped_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.pii import find, pattern_table

    docs = table(spark, sf_dir, "documents")
    return find(docs, pattern_table(docs))


@registered("op9_snapshot_collapse", """
WITH places AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
         count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE conv_id IS NOT NULL),
prefixes AS (
  SELECT conv_id, place, n, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY place) AS turns FROM places),
ends AS (SELECT n, turns, min(conv_id) AS conv_id FROM prefixes WHERE place = n GROUP BY n, turns),
kept AS (SELECT conv_id, n FROM ends e WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.place < p.n AND p.place = e.n AND p.turns = e.turns))
SELECT conv_id, any_value(kept.n) AS n_turns,
       string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY place) AS text
FROM kept JOIN places USING (conv_id) GROUP BY conv_id
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.chat import rendered

    return rendered(table(spark, sf_dir, "conversations"))


@registered("op10_block_pruned_search", """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.topk import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@registered("op11_hybrid_search", r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL),
docs AS (SELECT row, doc_id, len(t)::BIGINT AS n FROM texts WHERE len(t) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM docs),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
wanted AS (SELECT item_id, term, count(*)::BIGINT AS times FROM asked GROUP BY ALL),
postings AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(t) AS term FROM texts)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM postings GROUP BY ALL), totals),
scored AS (
  SELECT item_id, doc_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // words)))))::BIGINT AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN docs USING (row), totals GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.lexical import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered("op12_compression_quality")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.compression import learn, score_texts

    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, learn(docs, table(spark, sf_dir, "labels")))


@registered("op13_conversation_repair", r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS row,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations),
kinds AS (
  SELECT * EXCLUDE (bytes), xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda crc, b: list_reduce(
    [xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS kind
  FROM keyed),
hurt AS (
  SELECT conv_id, turn, row, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, (VALUES (0), (1)) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, row, copy) AS pos, substr(role, 1, 1) AS initial,
         right(rtrim(text, E' \t\n\x0B\x0C\r'), 1) AS ending
  FROM hurt),
judged AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lead(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS following
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM judged GROUP BY conv_id),
moves(p, c, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
inserts(p, q, cost, audit, lines) AS (
  SELECT s, s, 0, '', []::VARCHAR[] FROM range(4) AS r(s)
  UNION ALL SELECT p, q, 2, 'I', [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM moves WHERE c <> 's'
  UNION ALL SELECT a.p, b.q, 4, 'II', ['user:', 'assistant:'] FROM moves a JOIN moves b ON a.q = b.p AND a.c = 'u' AND b.c = 'a' WHERE a.p < 2),
edits AS (
  SELECT conv_id, pos, p, p AS q, 3 AS cost, 'D' AS audit, []::VARCHAR[] AS lines FROM judged, (SELECT unnest(range(4)) AS p)
  UNION ALL SELECT conv_id, pos, p, q, (fault = 'truncated')::INT, 'K', [role || ':' || text] FROM judged JOIN moves ON c = initial WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, p, q, 2 + (fault = 'truncated')::INT, 'R', [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] FROM judged JOIN moves ON c <> 's' WHERE fault NOT IN ('blank', 'duplicate')),
steps AS (
  SELECT conv_id, 0::BIGINT AS pos, q::BIGINT AS state, cost::BIGINT AS cost, audit, lines FROM counts, inserts WHERE p = 0
  UNION ALL
  SELECT s.conv_id, s.pos + 1, i.q, min(s.cost + e.cost + i.cost), arg_min(s.audit || e.audit || i.audit, printf('%012d', (s.cost + e.cost + i.cost)::BIGINT) || s.audit || e.audit || i.audit),
         arg_min(list_concat(s.lines, e.lines, i.lines), printf('%012d', (s.cost + e.cost + i.cost)::BIGINT) || s.audit || e.audit || i.audit)
  FROM steps s JOIN edits e ON s.conv_id IS NOT DISTINCT FROM e.conv_id AND e.pos = s.pos + 1 AND e.p = s.state JOIN inserts i ON i.p = e.q
  GROUP BY s.conv_id, s.pos, i.q),
repaired AS (
  SELECT c.conv_id, min(s.cost) AS cost, arg_min(audit, printf('%012d', s.cost) || audit) AS audit, arg_min(lines, printf('%012d', s.cost) || audit) AS lines
  FROM counts c JOIN steps s ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.pos WHERE state IN (0, 3) GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(array_to_string(coalesce(lines, []), chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from telescry.llm.repair import repair

    return repair(table(spark, sf_dir, "conversations"))
