"""The thin queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import (bpe, centroid_clustering, decontaminate, fixity, jaccard_join, langid, packing, prefix_trie, quality, quality_rules,
                            token_index, toxicity, url_filter)
from helixframe.session import scratch_path
from helixframe.sources.tables import read_table

#: The url rules of the contract: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages", "page_id", "url"), rules)


def _url_sql() -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
cut AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS raw FROM rest),
part AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM cut),
rules(rh, rp, rv) AS (VALUES {values}),
hit AS (
  SELECT part.*, rh || rp AS rule, rv,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC) AS k
  FROM part LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM hit WHERE k = 1"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                         read_table(spark, sf_dir, "benchmark", "item_id", "text"))


_SHINGLES = r"""
{d}_words AS (SELECT {key} AS k, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {d}),
{d}_sh AS (SELECT DISTINCT k, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS sh FROM {d}_words)"""

_DECONTAMINATION_SQL = "WITH " + _SHINGLES.format(d="documents", key="doc_id") + "," + _SHINGLES.format(d="benchmark", key="item_id") + """,
size AS (SELECT k, count(*) AS n FROM benchmark_sh GROUP BY k)
SELECT d.k AS doc_id, b.k AS item_id, count(*) AS n_shared, any_value(size.n) AS n_item, count(*) / any_value(size.n) AS containment
FROM documents_sh d JOIN benchmark_sh b USING (sh) JOIN size ON size.k = b.k
GROUP BY d.k, b.k HAVING count(*) >= 0.8 * any_value(size.n) - 1e-6"""


def op3_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index.token_file_digest(read_table(spark, sf_dir, "documents", "doc_id", "text"), scratch_path(spark, "token_ids"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                  read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                    read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_predictions(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read_table(spark, sf_dir, "documents", "doc_id", "text")).drop("uid", "keeper")


_JACCARD_SQL = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
gram AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                                      WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END) AS g FROM doc_words),
size AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS same FROM gram GROUP BY doc_id),
rep AS (SELECT same, min(doc_id) AS copy_of, count(*) AS copies, any_value(n) AS n FROM size GROUP BY same),
rep_gram AS (SELECT copy_of AS r, g FROM rep JOIN gram ON gram.doc_id = rep.copy_of),
pair AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM rep_gram a JOIN rep_gram b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
link AS (SELECT a, b, y.copies AS m FROM pair JOIN rep x ON x.copy_of = a JOIN rep y ON y.copy_of = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
walk AS (SELECT copy_of AS r, copy_of AS root FROM rep UNION SELECT link.b, walk.root FROM walk JOIN link ON link.a = walk.r),
named AS (SELECT r, min(root) AS class_id FROM walk GROUP BY r),
degree AS (SELECT a AS r, sum(m) AS k FROM link GROUP BY a)
SELECT d.doc_id, coalesce(named.class_id, d.doc_id) AS class_id, coalesce(rep.copy_of, d.doc_id) AS copy_of,
       CAST(coalesce(rep.copies - 1 + coalesce(degree.k, 0), 0) AS BIGINT) AS n_links
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN rep ON rep.same = size.same
LEFT JOIN named ON named.r = rep.copy_of LEFT JOIN degree ON degree.r = rep.copy_of"""


#: Records of the second replica whose id's md5 begins below this are damaged, about one in 43.
FAULT_BELOW = "06"


def op10_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fault = F.substring(F.md5(F.col("record_id").cast("string").cast("binary")), 1, 2) < FAULT_BELOW
    return fixity.fixity_report(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), fault)


_FIXITY_SQL = f"""
WITH body AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, chr(13) || chr(10) AS nl FROM pages),
record AS (
  SELECT page_id, 'WARC/1.1' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:record:' || coalesce(CAST(page_id AS VARCHAR), '')
         || '>' || nl || 'WARC-Target-URI: ' || url || nl || 'Content-Type: text/html' || nl || 'Content-Length: '
         || CAST(strlen(html) AS VARCHAR) || nl || nl || html || nl || nl AS r FROM body),
leaf AS (
  SELECT page_id, CAST(strlen(r) AS BIGINT) AS length, sha256(r) AS sha256, count(*) AS copies,
         ('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), 'null') || ':' || sha256(r)), 1, 15))::BIGINT AS place
  FROM record GROUP BY ALL),
tree AS (SELECT (SELECT min(l) FROM range(0, 15) t(l) WHERE CAST(pow(16, l + 1) AS HUGEINT) >= (SELECT count(*) FROM leaf)) AS levels),
placed AS (SELECT leaf.*, CASE WHEN levels <= 2 THEN 0 ELSE place >> CAST(60 - 4 * (levels - 2) AS BIGINT) END AS segment FROM leaf, tree)
SELECT page_id, length, sha256, copies, NOT coalesce(substr(md5(CAST(page_id AS VARCHAR)), 1, 2) < '{FAULT_BELOW}', false) AS intact, segment,
       CAST(sum(length * copies) OVER (PARTITION BY segment ORDER BY place, page_id NULLS FIRST, sha256) - length * copies AS BIGINT) AS segment_offset
FROM placed"""


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.centroid_clusters(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _cluster_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    parts = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
cell AS MATERIALIZED (SELECT r, unnest(range(1, {dim + 1})) AS i, unnest(x) AS v FROM kept),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c, x FROM kept
  ORDER BY c LIMIT {k})"""]
    for t in range(rounds + 1):
        parts.append(f"""
a{t} AS MATERIALIZED (
  SELECT r, c, d FROM (
    SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM (
      SELECT r, c, list_sum(list_transform(list_zip(kept.x, c{t}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{t}))
  WHERE place = 1)""")
        if t < rounds:
            parts.append(f"""
c{t + 1} AS MATERIALIZED (
  SELECT c{t}.c, coalesce(m.x, c{t}.x) AS x FROM c{t} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
      SELECT c, i, sum(v)::BIGINT AS s, count(*)::BIGINT AS n FROM a{t} JOIN cell USING (r) GROUP BY c, i) GROUP BY c) m USING (c))""")
    return "WITH" + ",".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(z.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} z ON z.c = a.c"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = prefix_trie.turn_keys(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    own = F.col("conv_id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return prefix_trie.prefix_trie(prefix_trie.paths(keys, parts, own - own % 5, prefix_trie.borrowed_head))


# unsigned crc32 of a short ASCII text, bit by bit
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END))"""

_TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS p FROM turns),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor({_CRC}, 4294967295::BIGINT) % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS MATERIALIZED (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS p, k, bytes FROM (
    SELECT ids.conv_id AS c, 0 AS part, own.p, k, bytes FROM ids JOIN own ON own.conv_id = base AND own.p <= h
    UNION ALL SELECT ids.conv_id, 1, own.p, k, bytes FROM ids JOIN own ON own.conv_id = ids.conv_id AND own.p > h)),
seq AS (SELECT ids.conv_id AS c, coalesce(list(k ORDER BY p) FILTER (WHERE k IS NOT NULL), []) AS ks, coalesce(list(bytes ORDER BY p) FILTER (WHERE k IS NOT NULL), []) AS bs
        FROM ids LEFT JOIN rebuilt ON rebuilt.c = ids.conv_id GROUP BY ids.conv_id),
prefix AS MATERIALIZED (SELECT c, len(ks) AS n, d, ks[1:d] AS path, CASE WHEN d = 0 THEN 0 ELSE bs[d] END AS bytes FROM seq, LATERAL (SELECT unnest(range(0, len(ks) + 1)) AS d)),
node AS MATERIALIZED (
  SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM prefix GROUP BY d, path),
kids AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
full_node AS MATERIALIZED (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (d, path)),
subtree AS (
  SELECT up AS d, path[1:up] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM full_node, LATERAL (SELECT unnest(range(0, d + 1)) AS up) GROUP BY ALL)
SELECT x.conv_id, x.d AS depth, parent.conv_id AS parent_conv_id, x.n_convs, x.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, x.ends_sha256
FROM full_node x JOIN subtree USING (d, path) LEFT JOIN node parent ON parent.d = x.d - 1 AND parent.path = x.path[1:x.d - 1]"""


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


Q = {
    "op1_url_filter": (op1_url_filter, _url_sql()),
    "op2_decontamination": (op2_decontamination, _DECONTAMINATION_SQL),
    "op3_token_index": (op3_token_index, None),
    "op4_quality_classifier": (op4_quality_classifier, None),
    "op5_toxicity": (op5_toxicity, None),
    "op6_packing": (op6_packing, None),
    "op7_quality_rules": (op7_quality_rules, None),
    "op8_language_id": (op8_language_id, None),
    "op9_jaccard_join": (op9_jaccard_join, _JACCARD_SQL),
    "op10_fixity": (op10_fixity, _FIXITY_SQL),
    "op11_centroid_clustering": (op11_centroid_clustering, _cluster_sql()),
    "op12_prefix_trie": (op12_prefix_trie, _TRIE_SQL),
    "op13_bpe": (op13_bpe, None),
}


def registry() -> dict:
    return dict(Q)
