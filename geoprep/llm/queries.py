"""Registered queries of this package (``opN_<name>``) and their SQL where it exists.

Each query applies its operator with production parameters to the whole of its table and
derives the columns of its result contract from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii
from .common import table
from .conversations import damage, digests, repair, repaired_rows
from .hard_negatives import mine
from .hash_tree import default_tree, shard_documents
from .html_text import extract_main_text
from .jaccard import similarity_classes
from .minhash import near_duplicate_classes
from .phrases import contamination
from .quality import score_quality
from .token_counts import count_tokens
from .topk import top_k
from .toxicity import score_toxicity
from .unigram import round_trip

PIECES = "piece_bpe_32k.model"
SHARDS = 8


def tokenizer_path(name: str = PIECES) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.extract(table(spark, sf_dir, "documents"))

    def of_kind(i: int):
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")

    count = [of_kind(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return out.select("doc_id", *count, F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("spans").alias("spans"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_main_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents"), words=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, query_step=50)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"), default_tree(SHARDS), default_tree(SHARDS + 1))
    return out.selectExpr("doc_id", "size", "text_crc32", "'key' AS law", "shard", "slot", "grown_shard")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), words=3, percent=85)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    edits, summary = repair(damage(talks))
    hashed = digests(repaired_rows(edits)).withColumnRenamed("key", "__key")
    none = F.lit(0).cast("long")
    out = talks.select("conv_id").distinct().join(summary.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")), "left")
    out = out.join(hashed, F.col("conv_id").cast("string").eqNullSafe(F.col("__key")), "left")
    return out.select("conv_id", *[F.coalesce(c, none).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_main_text, op3_quality, op4_toxicity, op5_jaccard_join, op6_exact_topk, op7_decontamination, op8_token_counts,
    op9_hash_tree_shards, op10_sentencepiece, op11_hard_negatives, op12_minhash_dedup,
    op13_conversation_repair)}

#: The search in plain SQL: every query against every row, ranked.
OP6_SQL = """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.uid, q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.uid <> c.uid AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

#: Every run of as many words as a window has, looked up among the windows.
OP7_SQL = r"""
WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
cut AS (SELECT item_id, w, CAST(unnest(range(1, greatest(len(w) - 8, 2))) AS BIGINT) AS i FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS p
        FROM cut),
dw AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
lens AS (SELECT DISTINCT l FROM win),
runs AS (SELECT rid, w, l, CAST(unnest(range(1, len(w) - l + 2)) AS BIGINT) AS i FROM dw, lens WHERE len(w) >= l),
hit AS (SELECT DISTINCT rid, r.i, r.l, item_id FROM runs r
        JOIN win ON win.l = r.l AND win.p = array_to_string(list_slice(r.w, r.i, r.i + r.l - 1), ' ')),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM hit) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
       FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (rid) LEFT JOIN it USING (rid)
"""

#: Shared shingles of all pairs, the links among them, and the smallest id that links reach.
LINKS_SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS w FROM documents),
sets AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < @K@ THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - @K@ + 2), lambda i: array_to_string(list_slice(w, i, i + @K@ - 1), ' '))) END AS s FROM w),
one AS (SELECT min(rid) AS rid, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
each AS (SELECT rid, n, unnest(s) AS t FROM one),
links AS (SELECT a.rid AS a, b.rid AS b FROM each a JOIN each b ON a.t = b.t AND a.rid < b.rid AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
          GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rid AS a, rid AS b FROM one UNION SELECT r.a, e.b FROM reach r JOIN both_ e ON e.a = r.b),
class AS (SELECT a AS rid, min(b) AS label FROM reach GROUP BY a),
rows_ AS (SELECT sets.doc_id, len(sets.s) AS n, label FROM sets LEFT JOIN one ON one.s = list_sort(sets.s) LEFT JOIN class ON class.rid = one.rid),
named AS (SELECT doc_id, n, CASE WHEN label IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY label) END AS component_id FROM rows_)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id@MORE@ FROM named
"""

#: Positives and negatives of every anchor, ranked over all rows.
OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.uid, a.vec_id AS anchor_id, c.uid AS other, c.vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.uid <> c.uid AND len(a.e) = len(c.e) WHERE a.vec_id % 50 = 0),
pos AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) <= 5),
neg AS (SELECT p.anchor_id, p.uid, p.other, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.uid, p.other ORDER BY n.score DESC, n.vec_id) AS rank
        FROM pos p JOIN s n ON n.uid = p.uid AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""

#: What can be done about one row (code: initial s, u, a, x; then . fine, t truncated, r refused), Inserts before it
#: included, from one state of the pattern to another; and the Inserts after the last row.
def _edits() -> tuple[str, str]:
    turn = {"n": "u", "s": "u", "u": "a", "a": "u"}              # the next role, which is also the next state
    rows, ends = [], []
    for p in "nsua":
        q, way = p, ""
        for inserts in range(3):
            if q in "na":
                ends.append((p, 2 * inserts, way))
            for initial in "suax":
                for flag in ".tr":
                    rows.append((p, initial + flag, q, 3 + 2 * inserts, way + "D."))
                    if flag != "r":
                        if initial == turn[q] or (q, initial) == ("n", "s"):
                            rows.append((p, initial + flag, initial, (flag == "t") + 2 * inserts, way + "K."))
                        rows.append((p, initial + flag, turn[q], 2 + (flag == "t") + 2 * inserts, way + "R" + turn[q]))
            way, q = way + "I" + turn[q], turn[q]
    return ",".join(f"('{p}','{c}','{q}',{n},'{w}')" for p, c, q, n, w in rows), ",".join(f"('{p}',{n},'{w}')" for p, n, w in ends)


#: Cheapest edits by a row-by-row minimum over the four states of the pattern.
OP13_SQL = r"""
WITH RECURSIVE poly AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
crc AS (SELECT v, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(v, ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS k
  FROM (SELECT DISTINCT coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS v FROM conversations), poly),
raw AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text, k
  FROM conversations c JOIN crc ON v = coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') WHERE k <> 0),
dmg AS (SELECT conv_id, turn, role, text FROM raw UNION ALL SELECT conv_id, turn, role, text FROM raw WHERE k = 3),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM dmg),
flt AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS rep,
    rtrim(text, E' \t\n\x0b\x0c\r') AS body, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS nxt FROM num),
one AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN rep > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '.' END AS f,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS ini FROM flt),
cod AS (SELECT *, ini || CASE WHEN f IN ('b', 'd') THEN 'r' ELSE f END AS code FROM one),
way(p, code, q, n, w) AS (VALUES @WAYS@),
fin(p, n, w) AS (VALUES @ENDS@),
best AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 'n' AS q, {'c': CAST(0 AS BIGINT), 'a': ''} AS b FROM cod GROUP BY conv_id
  UNION ALL
  SELECT o.conv_id, o.i, w.q, min({'c': b.b.c + w.n, 'a': b.b.a || w.w}) FROM best b
  JOIN cod o ON o.conv_id IS NOT DISTINCT FROM b.conv_id AND o.i = b.i + 1 JOIN way w ON w.p = b.q AND w.code = o.code
  GROUP BY o.conv_id, o.i, w.q),
tot AS (SELECT conv_id, count(*) AS n, min(turn) AS lo, max(turn) AS hi, count(DISTINCT turn) AS d, count(*) FILTER (f = 'b') AS blank,
    count(*) FILTER (f = 'd') AS dup, count(*) FILTER (f = 't') AS trunc,
    count(*) FILTER (nxt IS NOT NULL AND left(role, 1) || nxt NOT IN ('su', 'ua', 'au')) AS illegal FROM one GROUP BY conv_id),
win AS (SELECT t.conv_id, min({'c': b.b.c + e.n, 'a': b.b.a || e.w}) AS b FROM tot t
  JOIN best b ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND b.i = t.n JOIN fin e ON e.p = b.q GROUP BY t.conv_id),
ops AS (SELECT conv_id, unnest(regexp_extract_all(b.a, '..')) AS op, unnest(range(len(b.a) // 2)) AS pos FROM win),
row_of AS (SELECT *, count(*) FILTER (op[1] <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS i FROM ops),
txt AS (SELECT r.conv_id, string_agg(CASE WHEN op[1] = 'K' THEN o.role WHEN op[2] = 'u' THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN op[1] = 'I' THEN '' ELSE o.text END, chr(10) ORDER BY pos) AS t
  FROM row_of r LEFT JOIN cod o ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND o.i = r.i WHERE op[1] <> 'D' GROUP BY r.conv_id)
SELECT c.conv_id, CAST(coalesce(hi - lo + 1 - d, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(dup, 0) AS BIGINT) AS duplicate, CAST(coalesce(trunc, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(w.b.c, 0) AS BIGINT) AS cost,
    coalesce(regexp_replace(w.b.a, '(.).', '\1', 'g'), '') AS audit, sha256(coalesce(x.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN tot ON tot.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN win w ON w.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN txt x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
"""
OP13_SQL = OP13_SQL.replace("@WAYS@", _edits()[0]).replace("@ENDS@", _edits()[1])

ORACLE = {"op6_exact_topk": OP6_SQL, "op7_decontamination": OP7_SQL, "op11_hard_negatives": OP11_SQL,
          "op5_jaccard_join": LINKS_SQL.replace("@K@", "4").replace("@MORE@", ""),
          "op12_minhash_dedup": LINKS_SQL.replace("@K@", "3").replace("@MORE@", ", doc_id = component_id AS kept"),
          "op13_conversation_repair": OP13_SQL}
