"""The registered queries of the subpackage: thin digests of the operators' results.

Every query reads its whole table.  ``ORACLE`` has DuckDB SQL where SQL can express
the result; the others are tested against brute force.
"""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, tokenizer_path
from .conversation_repair import damaged, repair_table
from .decontaminate import contaminated_spans, leak_digest
from .hard_negatives import hard_negatives
from .language_id import identify
from .line_dedup import MIN_WORDS, deduplicate_lines
from .mixing import mix_table
from .ngram_join import near_duplicates
from .packing import pack_documents
from .quality_rules import calibrated, quality_table
from .secret_scan import secret_digest, secret_spans
from .substring_dedup import near_duplicate_passages
from .url_filter import url_verdicts
from .vector_topk import top_k

# Fixed rules of op2.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read_table(spark, sf_dir, "pages"), URL_RULES, html_col="html")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_passages(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (deduplicate_lines(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_removed", "removed", F.md5("text").alias("kept_md5")))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(secret_spans(read_table(spark, sf_dir, "documents")))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_table(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_table(docs, calibrated(docs))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_digest(contaminated_spans(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = read_table(spark, sf_dir, "conversations")
    return repair_table(convs, damaged(convs))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_url_filters, op3_substring_dedup, op4_line_dedup, op5_secret_scans, op6_exact_topk,
    op7_mixing, op8_quality_rules, op9_language_id, op10_best_fit_packing, op11_benchmark_decontamination,
    op12_conversation_repair, op13_hard_negatives)}
QUERIES["pipeline"] = corpus_pipeline.run

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op1_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, md5(unnest(s)) AS g FROM s),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id),
link AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
         WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, way.y FROM reach r JOIN way ON way.x = r.b)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n"""

ORACLE["op4_line_dedup"] = f"""
WITH RECURSIVE l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
p AS (SELECT doc_id, ls, unnest(range(0, len(ls))) AS pos FROM l),
q AS (SELECT doc_id, pos, ls[pos + 1] AS line, len(regexp_extract_all(ls[pos + 1], '{_WORD}')) AS words FROM p),
sym AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq FROM q WHERE words > 0),
block AS (SELECT doc_id, seq, 1 AS len, words, md5(line) AS h, row_number() OVER (PARTITION BY line ORDER BY doc_id, seq) > 1 AS later
    FROM sym QUALIFY count(*) OVER (PARTITION BY line) > 1
  UNION ALL
  SELECT doc_id, seq, len, words, h, row_number() OVER (PARTITION BY h ORDER BY doc_id, seq) > 1
  FROM (SELECT b.doc_id, b.seq, b.len + 1 AS len, b.words + s.words AS words, md5(b.h || s.line) AS h
        FROM block b JOIN sym s ON s.doc_id = b.doc_id AND s.seq = b.seq + b.len)
  QUALIFY count(*) OVER (PARTITION BY h) > 1),
marks AS (SELECT doc_id, seq, max(len) AS len FROM block WHERE later GROUP BY doc_id, seq HAVING max(words) >= {MIN_WORDS}),
gone AS (SELECT DISTINCT doc_id, unnest(range(seq, seq + len)) AS seq FROM marks),
isle AS (SELECT g.doc_id, s.pos, g.seq - row_number() OVER (PARTITION BY g.doc_id ORDER BY g.seq) AS isle
         FROM gone g JOIN sym s ON s.doc_id = g.doc_id AND s.seq = g.seq),
runs AS (SELECT doc_id, min(pos) AS a, max(pos) AS b FROM isle GROUP BY doc_id, isle),
per AS (SELECT doc_id, sum(b - a + 1) AS n, string_agg(a || '-' || b, ',' ORDER BY a) AS removed,
               list({{'a': a, 'b': b}}) AS runs FROM runs GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(per.n, 0)::BIGINT AS n_removed,
  coalesce(per.removed, '') AS removed,
  CASE WHEN per.n IS NULL THEN md5(text) ELSE md5(array_to_string(list_transform(list_filter(range(0, len(ls)),
    lambda i: len(list_filter(runs, lambda r: r.a <= i AND i <= r.b)) = 0), lambda i: ls[i + 1]), chr(10))) END AS kept_md5
FROM l LEFT JOIN per ON per.doc_id = l.doc_id"""

ORACLE["op6_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""


_ITEM_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"

ORACLE["op11_benchmark_decontamination"] = f"""
WITH i AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
        lambda a: array_to_string(w[a:a + 9], ' '))) AS g FROM i WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM documents),
q AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM p)),
hit AS (SELECT q.r, q.a, q.n, p.item_id FROM q JOIN p ON p.n = q.n AND p.g = array_to_string(q.w[q.a:q.a + q.n - 1], ' ')),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(a, a + n)) AS k FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


def _plus(cell: str, cost: str, edit: str) -> str:
    """A cell is nine digits of cost and the audit, so text order is (cost, audit) order."""
    return f"(lpad(({cell}[1:9]::BIGINT + {cost})::VARCHAR, 9, '0') || {cell}[10:] || '{edit}')"


_INSERTED = f"""c0 AS e0, c1 AS e1, least(c2, {_plus("c0", "3", "I")}, {_plus("c1", "3", "I")}, {_plus("c3", "3", "I")}) AS e2,
    least(c3, {_plus("least(c2, " + _plus("c0", "3", "I") + ", " + _plus("c1", "3", "I") + ")", "3", "I")}) AS e3"""
_INTO_USER = "least(e0, e1, e3)"

# The repair as a path over the rows: place in the role sequence x row, cheapest (cost, audit) first.
ORACLE["op12_conversation_repair"] = f"""
WITH RECURSIVE bits AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 20 AS d FROM conversations, bits),
dmg AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
cid AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
o AS (SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), copy) AS k,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM dmg JOIN cid ON dmg.conv_id IS NOT DISTINCT FROM cid.conv_id),
f AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 THEN 'duplicate'
    WHEN body[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS z,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY k) AS before FROM o),
counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || z NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n FROM f GROUP BY c),
path AS (SELECT c, 0::BIGINT AS k, '000000000' AS c0, NULL::VARCHAR AS c1, NULL::VARCHAR AS c2, NULL::VARCHAR AS c3 FROM cid
  UNION ALL
  SELECT c, k, {_plus("e0", "4", "D")},
    least({_plus("e1", "4", "D")}, CASE WHEN stays AND z = 's' THEN {_plus("e0", "t", "K")} END),
    least({_plus("e2", "4", "D")}, CASE WHEN stays AND z = 'u' THEN {_plus(_INTO_USER, "t", "K")} END,
          CASE WHEN stays THEN {_plus(_INTO_USER, "t + 3", "R")} END),
    least({_plus("e3", "4", "D")}, CASE WHEN stays AND z = 'a' THEN {_plus("e2", "t", "K")} END,
          CASE WHEN stays THEN {_plus("e2", "t + 3", "R")} END)
  FROM (SELECT path.c, f.k, f.z, f.fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS t,
    {_INSERTED} FROM path JOIN f ON f.c = path.c AND f.k = path.k + 1)),
done AS (SELECT c, least(e0, e3) AS cell FROM (SELECT path.c, {_INSERTED} FROM path LEFT JOIN counts ON counts.c = path.c
    WHERE path.k = coalesce(n, 0))),
edit AS (SELECT c, cell[10:] AS audit, unnest(range(1, len(cell) - 8)) AS a FROM done),
walk AS (SELECT c, a, audit[a] AS e, len(replace(audit[1:a], 'I', '')) AS k, len(replace(audit[1:a], 'D', '')) AS out,
    len(replace(audit, 'D', '')) % 2 AS lead FROM edit),
fixed AS (SELECT walk.c, a, CASE WHEN e = 'K' THEN role WHEN (out - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN e = 'I' THEN '' ELSE text END AS line FROM walk LEFT JOIN f ON f.c = walk.c AND f.k = walk.k AND e <> 'I' WHERE e <> 'D'),
lines AS (SELECT c, string_agg(line, chr(10) ORDER BY a) AS whole FROM fixed GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cell[1:9]::BIGINT AS cost,
  cell[10:] AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM cid JOIN done USING (c) LEFT JOIN counts USING (c) LEFT JOIN lines USING (c)"""

ORACLE["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
      FROM v a JOIN v c ON a.id <> c.id AND len(a.v) = len(c.v) WHERE a.id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth FROM s WHERE same),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
      row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
      WHERE nth <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
