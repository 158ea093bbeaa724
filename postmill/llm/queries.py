"""The registered queries of this package and, where SQL can say it, the equal DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.block_labeller import extract
from postmill.llm.common import table
from postmill.llm.conversation_trie import regrouped_trie
from postmill.llm.decontaminate import leaks
from postmill.llm.license_scan import licenses
from postmill.llm.mixing import mix
from postmill.llm.periodic_runs import periodic_runs, planted, run_digests
from postmill.llm.personal_data import find_personal_data
from postmill.llm.quality_rules import judge
from postmill.llm.secret_scan import find_secrets
from postmill.llm.shingle_join import similar_documents
from postmill.llm.token_counts import count_tokens
from postmill.llm.token_files import encode_corpus
from postmill.llm.toxicity import toxicity

VOCABULARY = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


SQL["op7_shingle_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM d
), u AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM u AS a JOIN u AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach(doc_id, other) AS (
  SELECT x, y FROM links
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(r.low, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) AS r ON r.doc_id = s.doc_id
"""


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


SQL["op8_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT AS h
  FROM documents
), s AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^ 	-
]+'))::BIGINT AS size,
         -ln((h::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / greatest(0.05::DOUBLE, 1::DOUBLE - 5::DOUBLE * (length(t) - length(translate(t, '#*$%&|<>', '')))::DOUBLE
                    / greatest(length(t), 1)::DOUBLE) AS key
  FROM d
), w AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM s GROUP BY source
), f AS (
  SELECT *, source_size * 2::DOUBLE / weight AS full_at FROM w
), l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(source_size) OVER (ORDER BY full_at, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2::DOUBLE)
            / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (ORDER BY full_at, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM f
), v AS (
  SELECT arg_min(level, full_at) FILTER (WHERE level <= full_at) AS level FROM l
), g AS (
  SELECT f.source, source_size, coalesce(least(source_size * 2::DOUBLE, v.level * weight), source_size * 2::DOUBLE) AS target
  FROM f, v
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM (
  SELECT s.doc_id, s.size, e.source_size, e.target,
         e.epochs + CASE WHEN target - epochs * source_size > 0 AND
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id NULLS FIRST, s.size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size / 2.0::DOUBLE
           <= target - epochs * source_size THEN 1 ELSE 0 END AS copies
  FROM s JOIN e ON s.source IS NOT DISTINCT FROM e.source
)
"""


# Files of a tree: source, language, fifty documents a directory; every fiftieth is a licence file,
# in turn of the language's directory and of its own.
FILE_PATH = """
concat_ws('/', coalesce(source, '-'), coalesce(lang, '-'),
          CASE WHEN doc_id % 100 <> 0 THEN CAST(doc_id DIV 50 AS STRING) END,
          CASE WHEN doc_id % 50 = 0 THEN 'LICENSE' ELSE concat(CAST(doc_id AS STRING), '.txt') END)
"""


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents").withColumn("path", F.expr(FILE_PATH)))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), limit=512)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return run_digests(periodic_runs(docs.withColumn("text", planted(F.col("text"), F.col("doc_id")))))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regrouped_trie(table(spark, sf_dir, "conversations"))


# CRC-32 by its table of 256 remainders, which the first two statements work out.
SQL["op12_conversation_trie"] = r"""
WITH remainders AS (
  SELECT b, list_reduce(list_prepend(b, range(8)),
                        lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
  FROM range(256) AS t(b)
), crc AS (
  SELECT list(r ORDER BY b) AS r FROM remainders
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS place,
         md5(coalesce(role, '')) || md5(coalesce(text, '')) AS word, strlen(coalesce(text, '')) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS head,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
                         lambda c, x: xor(c >> 8, r[(xor(c, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc
), rebuilt AS (
  SELECT ids.conv_id, 0 AS part, place, word, n_bytes FROM ids JOIN turns ON turns.conv_id = ids.head AND place < h
  UNION ALL
  SELECT ids.conv_id, 1, place, word, n_bytes FROM ids JOIN turns ON turns.conv_id = ids.conv_id AND place >= h
), prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(word, '') OVER w AS path, n_bytes,
         row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS ends
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
  UNION ALL
  SELECT conv_id, 0, '', 0, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM ids
), nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, path
), children AS (
  SELECT depth - 1 AS depth, path[:(depth - 1) * 64] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), family AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, path)
), below AS (
  SELECT p.depth, p.path, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((f.n_convs - 1) * f.n_bytes)::BIGINT AS saved_tokens
  FROM family AS f JOIN prefixes AS p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY ALL
)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM family AS f JOIN below USING (depth, path)
LEFT JOIN nodes AS up ON f.depth > 0 AND up.depth = f.depth - 1 AND up.path = f.path[:(f.depth - 1) * 64]
"""


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
