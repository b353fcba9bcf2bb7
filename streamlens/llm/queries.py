"""Registered queries of the operators, over whole tables; each takes session and folder."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm import audit, decontaminate, html, jaccard, langid, licenses, mixing, neighbours, pii, prefixtrie, substrings, tokenfiles, urls
from streamlens.llm.tables import table
from streamlens.sources.scratch import fresh_folder

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def importable_on_workers(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def registered(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            importable_on_workers(spark)
            return query(spark, folder)

        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return run

    return add


# The vocabulary and the end-of-document id of the token files.
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2


def token_report(documents: DataFrame) -> DataFrame:
    """Write the token files of ``documents`` and read back one row per document."""
    import public_tokenizers

    spark = documents.sparkSession
    path = fresh_folder(spark, "tokens")
    dtype = tokenfiles.write(documents, path, public_tokenizers.path(VOCABULARY), END_ID)
    return tokenfiles.read(spark, path, dtype)


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

# Every window of 20 words against all others; words that a late one covers go.
_SUBSTRINGS_SQL = f"""
WITH words AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20
), late AS (
  SELECT doc_id, s FROM starts
  QUALIFY row_number() OVER (PARTITION BY array_to_string(w[s : s + 19], ' ') ORDER BY doc_id, s) > 1
), covered AS (
  SELECT DISTINCT doc_id, s + o AS i FROM late, range(20) AS r(o)
), places AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM places p ANTI JOIN covered c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
# All pairs that share a shingle, and what can be reached by links.
_JACCARD_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, unnest([array_to_string(w[s : s + 4], ' ')
                           FOR s IN range(1, greatest(len(w) - 3, 2))]) AS k
    FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT p.x, p.y
  FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM shingles a JOIN shingles b ON a.k = b.k GROUP BY ALL) AS p
  JOIN sizes m ON m.doc_id = p.x JOIN sizes n ON n.doc_id = p.y
  WHERE 100 * c >= 75 * (m.n + n.n - c)
), reached AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, coalesce(min(y), doc_id) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN reached ON x = doc_id GROUP BY doc_id
"""


@registered("op1_html_extraction")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages", "page_id", "url", "html"))


@registered("op9_pii")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pii.detect(table(spark, folder, "documents", "doc_id", "text"))


@registered("op10_license_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents", "doc_id", "text"))
    return found.drop("detections")


@registered("op3_token_files")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return token_report(table(spark, folder, "documents", "doc_id", "text"))


@registered("op6_source_mixing", mixing.oracle_sql())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents", "doc_id", "source", "text"))


@registered("op2_nearest_neighbours")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return neighbours.search(vectors, vectors.filter("vec_id % 50 = 0"), 5)


@registered("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text", "lang")
    learned = langid.train(documents, ~langid.held_out())
    found = langid.classify(documents.select("doc_id", "text"), learned)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@registered("op4_substring_dedup", _SUBSTRINGS_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    return substrings.remove_repeats(documents).drop("kept")


@registered("op8_jaccard_join", _JACCARD_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.cluster(table(spark, folder, "documents", "doc_id", "text"))


@registered("op7_decontamination")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    found = decontaminate.find(documents, table(spark, folder, "benchmark", "item_id", "text"))
    return found.select("doc_id", F.inline("leaks"))


@registered("op11_filter_audit", audit.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "source", "text")
    return audit.report(documents, table(spark, folder, "labels", "doc_id", "quality", "toxic"))


@registered("op13_url_filter")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    model = urls.train(urls.labelled(spark))
    found = urls.judge(table(spark, folder, "pages", "page_id", "url"), model)
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


# Every prefix of every rebuilt conversation, and every node below every node.
_TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
         sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'id': id, 'chars': chars} ORDER BY turn NULLS FIRST, id) AS t,
         list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c))),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.t, [])[: xor(a.crc, 4294967295) % 6],
                                a.t[xor(a.crc, 4294967295) % 6 + 1 :]) AS t
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100
), prefixes AS (
  SELECT conv_id, len(t) AS n_turns, d,
         md5(array_to_string(list_transform(t[: d], lambda x: x.id), ',')) AS k,
         md5(array_to_string(list_transform(t[: d - 1], lambda x: x.id), ',')) AS up,
         CASE WHEN d = 0 THEN 0 ELSE t[d].chars END AS chars
  FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(CASE WHEN d > 0 THEN up END) AS up, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                         FILTER (n_turns = d), '')) AS ends_sha256
  FROM prefixes GROUP BY d, k
), full_nodes AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.up = n.k) AS n_children FROM nodes n
), below AS (
  SELECT a.d, a.k, sum(v.saved) AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
  FROM full_nodes v JOIN prefixes p ON p.conv_id = v.conv_id AND p.d <= v.d
  JOIN nodes a ON a.d = p.d AND a.k = p.k GROUP BY a.d, a.k
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON b.d = n.d AND b.k = n.k
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.up
"""


@registered("op12_prefix_trie", _TRIE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.nodes(table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))
