"""Registered queries of the subpackage: one per operator, over its whole table.

Each takes ``(spark, sf_dir)``, applies its operator with production parameters and derives
the columns it reports from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, embed_dedup, fingerprint, jaccard_join, langid, license_scan, packing, pii,
               prefix_trie, quality, ranked_search, substring_dedup)
from .common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = bpe.read_ranks()
    df = bpe.decode(bpe.encode(docs, ranks, keep=["doc_id"]), ranks)
    return df.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                     F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document at 0.9 on 3-word shingles."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), num=90, den=100, n=3)


ORACLES["op5_jaccard_join"] = """
  WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
             lambda x: x <> '') AS ws FROM documents),
  s AS (
    SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1),
             lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
           WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
  n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
  c AS (SELECT list_sort(sh) AS k, min(doc_id) AS rep FROM s WHERE len(sh) > 0 GROUP BY 1),
  m AS (SELECT doc_id, rep FROM s JOIN c ON list_sort(s.sh) = c.k),
  e AS (SELECT s.doc_id, unnest(s.sh) AS g FROM s JOIN c ON s.doc_id = c.rep),
  f AS (SELECT g, count(*) AS df FROM e GROUP BY g HAVING count(*) > 1),
  p AS (SELECT x.doc_id, x.g, n.n, row_number() OVER (PARTITION BY x.doc_id ORDER BY coalesce(f.df, 1), x.g) AS r
        FROM e x JOIN n USING (doc_id) LEFT JOIN f USING (g)),
  cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b
           FROM (SELECT * FROM p WHERE r <= n - (9 * n + 9) // 10 + 1) a
           JOIN (SELECT * FROM p WHERE r <= n - (9 * n + 9) // 10 + 1) b
             ON a.g = b.g AND a.doc_id < b.doc_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)),
  o AS (SELECT cand.a, cand.b, count(*) AS o FROM cand JOIN e x ON x.doc_id = cand.a
        JOIN e y ON y.doc_id = cand.b AND y.g = x.g GROUP BY 1, 2),
  l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
        WHERE 100 * o >= 90 * (na.n + nb.n - o)),
  links AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
  reach AS (SELECT rep AS x, rep AS y FROM c UNION SELECT reach.x, links.b FROM reach JOIN links ON links.a = reach.y),
  comp AS (SELECT x, min(y) AS root FROM reach GROUP BY x)
  SELECT n.doc_id, n.n AS n_shingles, coalesce(comp.root, n.doc_id) AS component_id
  FROM n LEFT JOIN m USING (doc_id) LEFT JOIN comp ON comp.x = m.rep
"""


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of passages of 35 words that occur elsewhere too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = substring_dedup.remove_repeated(docs, window=35, keep=["doc_id"])
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op6_substring_dedup"] = """
  WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                               lambda x: x <> '') AS ws FROM documents),
  v AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS p FROM w WHERE len(ws) >= 35),
  k AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 34], ' ')) AS h FROM v),
  r AS (SELECT h FROM k GROUP BY h HAVING count(*) > 1),
  c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM k SEMI JOIN r USING (h)),
  g AS (SELECT doc_id, list(q) AS gone FROM c GROUP BY doc_id)
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
         sha256(array_to_string(list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)),
           lambda x: gone IS NULL OR NOT list_contains(gone, x[2])), lambda x: x[1]), ' ')) AS kept_sha256
  FROM w LEFT JOIN g USING (doc_id)
"""


@query
def op3_content_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their containments."""
    return fingerprint.compare_with_edited(table(spark, sf_dir, "documents"))


@query
def op8_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return langid.predict(docs, model, keep=["doc_id", "held_out"])


@query
def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.93 within labels."""
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


ORACLES["op9_cross_polytope"] = """
  WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
  l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
  reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, l.b FROM reach JOIN l ON l.a = reach.y),
  c AS (SELECT x, min(y) AS root FROM reach GROUP BY x),
  n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
  SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.root AS component_id, c.root = e.vec_id AS kept
  FROM embeddings e LEFT JOIN c ON c.x = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


@query
def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = pii.find_personal_data(docs, pii.fit(docs), keep=["doc_id"])
    return df.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                     F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query
def op1_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document from the two views, and whether it is kept."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.fit(docs, labels), keep=["doc_id"])


@query
def op7_paragraph_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs, license_scan.fit(docs))


@query
def op12_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of benchmark windows, and the items met."""
    df = decontaminate.find_phrases(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return df.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                     F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                     (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op12_fm_index"] = """
  WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
             lambda x: x <> '') AS ws FROM documents),
  b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
             lambda x: x <> '') AS ws FROM benchmark),
  q AS (SELECT DISTINCT item, z, array_to_string(ws[p:p + z - 1], ' ') AS k
        FROM (SELECT item, ws, least(10, len(ws)) AS z, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS p
              FROM b WHERE len(ws) > 0)),
  z AS (SELECT DISTINCT z FROM q),
  v AS (SELECT r, z, p, array_to_string(ws[p:p + z - 1], ' ') AS k
        FROM (SELECT r, ws, z, unnest(range(1, len(ws) - z + 2)) AS p FROM d JOIN z ON len(ws) >= z)),
  o AS (SELECT r, p, v.z, item FROM v JOIN q ON v.z = q.z AND v.k = q.k),
  h AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(p, p + z)) AS w FROM o) GROUP BY r),
  i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
         CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
         coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)
"""


@query
def op13_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


ORACLES["op13_fp_tree"] = """
  WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
             lambda x: x <> '') AS ws FROM documents),
  b AS (
    SELECT item_id, row_number() OVER () AS item, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
             lambda x: x <> '')) AS t FROM benchmark),
  q AS (SELECT item_id, item, t, count(*) AS c FROM b GROUP BY ALL),
  s AS (SELECT count(*) AS n_docs, sum(len(ws)) AS n_terms FROM d WHERE len(ws) > 0),
  f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d) GROUP BY ALL),
  w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY t, n_docs),
  m AS (SELECT doc_id, r, CAST(25 + (75 * len(ws) * n_docs) // n_terms AS BIGINT) AS m FROM d, s WHERE len(ws) > 0),
  x AS (SELECT item_id, item, doc_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL),
  k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST, r) AS rank FROM x WHERE score > 0)
  SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""


@query
def op11_centroid_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations with its subtree's sums."""
    df = prefix_trie.trie(table(spark, sf_dir, "conversations"))
    return df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLES["op11_centroid_trie"] = """
  WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS at
    FROM conversations WHERE conv_id IS NOT NULL),
  c AS (
    SELECT conv_id, count(*) AS n, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
             list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
             lambda a, d: list_reduce(list_concat([xor(a, d)], [CAST(x AS BIGINT) FOR x IN range(8)]),
               lambda b, i: CASE WHEN b & 1 = 1 THEN xor(b >> 1, CAST(3988292384 AS BIGINT)) ELSE b >> 1 END)) AS state
    FROM t GROUP BY conv_id),
  h AS (SELECT conv_id, n, xor(state, CAST(4294967295 AS BIGINT)) % 4 AS h, conv_id - conv_id % 20 AS base FROM c),
  g AS (SELECT h.conv_id, h.h, h.base, least(h.h, coalesce(b.n, 0)) AS shared FROM h LEFT JOIN h b ON b.conv_id = h.base),
  r AS (
    SELECT g.conv_id, t.at AS depth, role, text FROM g JOIN t ON t.conv_id = g.base AND t.at <= g.h
    UNION ALL
    SELECT g.conv_id, t.at - g.h + g.shared, role, text FROM g JOIN t ON t.conv_id = g.conv_id AND t.at > g.h),
  s AS (
    SELECT conv_id, depth, md5(to_json(list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth))) AS node,
           len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS words FROM r
    UNION ALL SELECT conv_id, 0, '', 0 FROM g),
  p AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
               depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM s),
  n AS (
    SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, count(*) AS n_convs, min(words) AS words,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM p GROUP BY node),
  k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
  w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
  u AS (
    SELECT p.node, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((w.n_convs - 1) * w.words) AS saved_tokens
    FROM w JOIN p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.node)
  SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children,
         CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
  FROM w JOIN u USING (node) LEFT JOIN n q ON q.node = w.parent
"""
