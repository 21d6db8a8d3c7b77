"""The registered queries of this folder, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinsieve.llm import (
    dialogue,
    merkle,
    mixing,
    neighbours,
    partenum,
    periodic,
    pieces,
    quartile,
    recompress,
    suffixes,
    toxicity,
    urls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


@query("op1_warc_archives")
def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from its byte range."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op2_quartile_fingerprints")
def quartile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's digest, its edited text's, and how near the next one's is."""
    return quartile.fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; trained on the labels of four folds of five."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_sentencepiece_codec")
def sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with an end id and decoded again."""
    return pieces.encode_documents(table(spark, sf_dir, "documents"), piece_model())


@query("op5_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document so that the sources meet their targets."""
    return mixing.mix_table(table(spark, sf_dir, "documents"))


@query("op6_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products for every twentieth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query(
    "op7_ngram_jaccard_join",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
      ELSE list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2)) END) AS g FROM words)),
ids AS (SELECT g, row_number() OVER () AS e FROM (SELECT DISTINCT g FROM grams)),
sets AS (SELECT doc_id, e FROM grams JOIN ids USING (g)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
commons AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM commons JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * c >= 90 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (
  SELECT x, x FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON d.doc_id = least.x
""",
)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles overlap by 0.9 or more."""
    return partenum.jaccard_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


@query(
    "op9_substring_dedup",
    r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, p, list_slice(w, p, p + 12) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words)),
firsts AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i
  FROM windows JOIN firsts USING (win) WHERE first_id < doc_id),
lists AS (SELECT doc_id, list(i) AS i FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, w,
         list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(coalesce(i, []), k)), lambda k: w[k]) AS k
  FROM words LEFT JOIN lists USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(k) AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
""",
)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that also start in a smaller document go."""
    return recompress.kept_digests(table(spark, sf_dir, "documents"))


@query("op8_url_filters")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by listed rules, else by mined ones."""
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@query(
    "op10_chat_perspectives",
    r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
parts AS (
  SELECT t.conv_id, perspective, CAST(i // 64 AS BIGINT) AS segment, i, text, role = perspective AS own,
         '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
           ELSE 'user name=' || replace(role, '<|', '< |') END || chr(10) AS head,
         '<|im_end|>' || chr(10) AS tail
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(text) + length(tail)) OVER (
      PARTITION BY conv_id, perspective, segment ORDER BY i) - length(text) - length(tail) AS pos FROM parts)
SELECT conv_id, perspective, segment, count(*) AS n_turns,
       string_agg(head || text || tail, '' ORDER BY i) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(pos AS BIGINT) || '-' || CAST(pos + length(text) AS BIGINT) END, ' ' ORDER BY i), '') AS mask,
       CAST(sum(CASE WHEN own THEN length(text) ELSE 0 END) AS BIGINT) AS n_masked
FROM placed GROUP BY conv_id, perspective, segment
""",
)
def chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation once for each of its speakers."""
    return dialogue.rotate_perspectives(table(spark, sf_dir, "conversations"))


# Checksum of a decimal doc_id, bit by bit: SQL has no function for it.
CRC32 = """xor(list_reduce(
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)),
    4294967295), 4294967295)"""


@query(
    "op11_periodic_runs",
    rf"""
WITH listed AS (
  SELECT doc_id, row_number() OVER () AS k, {CRC32} AS h,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sized AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM listed),
texts AS (
  SELECT doc_id, k, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1]
      ELSE w[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] END) ELSE w END AS w FROM sized),
words AS (SELECT k, n, unnest(w) AS x, unnest(range(n)) AS i FROM texts),
pairs AS (
  SELECT a.k, a.i AS j, b.i - a.i AS q FROM words a JOIN words b
  ON a.k = b.k AND a.x = b.x AND b.i > a.i AND b.i <= a.i + a.n // 4),
stretches AS (
  SELECT k, q, min(j) AS start, count(*) + q AS length
  FROM (SELECT k, q, j, j - row_number() OVER (PARTITION BY k, q ORDER BY j) AS island FROM pairs)
  GROUP BY k, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT k, start, length, min(q) AS period FROM stretches GROUP BY k, start, length),
gone AS (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT k, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (k, i) GROUP BY k),
digests AS (
  SELECT k, count(*) AS n_runs, arg_max((start, length, period), (length, -start, -period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
  1000 * best[2] // best[3] AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM texts LEFT JOIN digests USING (k) LEFT JOIN kept USING (k)
""",
)
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four periods or more in every text, every tenth with a planted tail."""
    return periodic.run_digests(table(spark, sf_dir, "documents"))


@query(
    "op12_merkle_manifest",
    rf"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, text, {CRC32} % 2 = 0 AS tampers,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place
  FROM documents),
leaves AS (
  SELECT doc_id, grp, place, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS changed
  FROM (SELECT *, CASE WHEN tampers THEN replace(text, chr(10), '') ELSE text END AS t FROM rows)),
nodes AS (
  SELECT 0 AS lvl, grp, place, leaf AS digest, count(*) OVER (PARTITION BY grp) AS n FROM leaves
  UNION ALL
  SELECT lvl + 1, grp, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY lvl, grp, place // 3, n),
tops AS (
  SELECT 0 AS lvl, grp AS place, digest, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT lvl + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
  FROM tops WHERE n > 1 GROUP BY lvl, place // 3, n),
marked AS (SELECT *, row_number() OVER () AS k FROM leaves),
climb AS (
  SELECT k, grp, place, 0 AS lvl, changed AS digest, '' AS proof FROM marked
  UNION ALL
  SELECT c.k, c.grp, c.place // 3, c.lvl + 1,
    sha256(string_agg(CASE WHEN s.place = c.place THEN c.digest ELSE s.digest END, '' ORDER BY s.place)),
    c.proof || coalesce(string_agg(CASE WHEN s.place <> c.place THEN s.digest END, '' ORDER BY s.place), '')
  FROM climb c JOIN nodes s ON s.grp = c.grp AND s.lvl = c.lvl AND s.place // 3 = c.place // 3 AND s.n > 1
  GROUP BY c.k, c.grp, c.place, c.lvl, c.digest, c.proof),
heights AS (SELECT grp, max(lvl) AS height, max(CASE WHEN n = 1 THEN digest END) AS subroot FROM nodes GROUP BY grp),
summit AS (
  SELECT k, c.grp AS place, 0 AS lvl, digest, proof FROM climb c JOIN heights h ON c.grp = h.grp AND c.lvl = h.height
  UNION ALL
  SELECT c.k, c.place // 3, c.lvl + 1,
    sha256(string_agg(CASE WHEN s.place = c.place THEN c.digest ELSE s.digest END, '' ORDER BY s.place)),
    c.proof || coalesce(string_agg(CASE WHEN s.place <> c.place THEN s.digest END, '' ORDER BY s.place), '')
  FROM summit c JOIN tops s ON s.lvl = c.lvl AND s.place // 3 = c.place // 3 AND s.n > 1
  GROUP BY c.k, c.place, c.lvl, c.digest, c.proof),
peak AS (SELECT lvl AS height, digest AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, s.digest AS folded_root, s.digest = root AS verified
FROM marked JOIN heights USING (grp) CROSS JOIN peak JOIN summit s ON s.k = marked.k AND s.lvl = peak.height
""",
)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf: its proof, checked against tampered texts."""
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


@query("op13_suffix_tree_scores")
def suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; learned from four folds of five."""
    return suffixes.score_documents(table(spark, sf_dir, "documents"))
