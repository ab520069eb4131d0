"""The registered queries of the training-data operators: each applies its
operator with production parameters to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from dimwright.llm.centroids import dictionary_clusters, with_digests
from dimwright.llm.common import table
from dimwright.llm.decontam import decontaminate
from dimwright.llm.embeddings import near_vectors
from dimwright.llm.langid import identify, learn
from dimwright.llm.merkle import fold, merkle_manifest, proof
from dimwright.llm.minhash import near_duplicates
from dimwright.llm.packing import pack_documents
from dimwright.llm.quality import STOP_WORDS, quality_rules
from dimwright.llm.sharding import minimax_shards
from dimwright.llm.simple8b import read_token_files, write_token_files
from dimwright.llm.substring import substring_dedup
from dimwright.llm.suffix import suffix_dedup
from dimwright.llm.toxicity import toxicity


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept_text", "uid")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))


def op7_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("uid")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("uid")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text", "uid")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(*dictionary_clusters(table(spark, sf_dir, "embeddings")))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words", F.array_join("failed_rules", ", ").alias("failed_rules"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document is tampered with: the capitals of its text are lowered."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    m = merkle_manifest(table(spark, sf_dir, "documents"), found={"text": F.when(third, lowered).otherwise(F.col("text"))})
    m = m.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), fold(F.col("path"), F.col("found_leaf")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_suffix_dedup, op3_packing, op4_sharding, op5_token_files, op6_language, op7_embedding_join,
        op8_minhash, op9_decontamination, op10_substring_dedup, op11_centroids, op12_quality, op13_merkle)}

ORACLE: dict[str, str] = {}

ORACLE["op10_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM d WHERE len(ws) >= 13),
k AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS w FROM win),
f AS (SELECT w, min(doc_id) AS m FROM k GROUP BY w),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM k JOIN f USING (w), range(0, 13) AS t(j) WHERE doc_id > m),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(10, len(ws)) AS l, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, l, array_to_string(list_slice(ws, i, i + l - 1), ' ') AS w FROM bi),
di AS (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM iw) WHERE len(ws) >= l),
dw AS (SELECT doc_id, l, i, array_to_string(list_slice(ws, i, i + l - 1), ' ') AS w FROM di),
hit AS (SELECT doc_id, i, l, item_id FROM dw JOIN iw USING (l, w)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS t
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(names.n, 0) AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN names USING (doc_id)
"""


def _sql_clusters(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """All rounds of op11, one after the other; a distance and its cluster are compared as one number."""
    near = (f"SELECT vec_id, x, min(list_sum(list_transform(range(1, {dims + 1}), lambda i: (x[i] - y[i]) * (x[i] - y[i])))::HUGEINT * {k} + c) AS m "
            "FROM v, c{r} GROUP BY vec_id, x")
    s = f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda z: CAST(floor(256 * CAST(z AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x AS y FROM v QUALIFY c < {k})"""
    for r in range(rounds):
        s += f""",
a{r} AS MATERIALIZED ({near.format(r=r)}),
p{r} AS (SELECT m % {k} AS c, unnest(range(1, {dims + 1})) AS i, unnest(x) AS z FROM a{r}),
f{r} AS (SELECT c, i, CAST((sum(z) - (sum(z) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS z FROM p{r} GROUP BY c, i),
n{r} AS (SELECT c, list(z ORDER BY i) AS y FROM f{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n{r}.y, c{r}.y) AS y FROM c{r} LEFT JOIN n{r} USING (c))"""
    return s + f""",
a AS MATERIALIZED ({near.format(r=rounds)})
SELECT vec_id, CAST(m % {k} AS INTEGER) AS cluster, CAST(m // {k} AS BIGINT) AS distance,
       CAST(sum(m // {k}) OVER (PARTITION BY m % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(m // {k}) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(y, ',')) AS centroid_sha256
FROM a JOIN c{rounds} ON c = m % {k}
"""


ORACLE["op11_centroids"] = _sql_clusters()

_SQL_STOP = ", ".join(f"'{w}'" for w in sorted({w for s in STOP_WORDS.values() for w in s.split()}))

ORACLE["op12_quality"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-]')) AS ls FROM documents),
k AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS w
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
p AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(0, 5) AS g(j) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words,
             CAST(len(list_filter(ws, lambda w: rtrim(lower(w), '.,;:!?') IN ({_SQL_STOP}))) AS BIGINT) AS n_stop_words,
             len(list_filter(ls, lambda x: ltrim(x)[1] IN ('-', '*', '•'))) AS n_bullet,
             len(list_filter(ls, lambda x: ends_with(rtrim(x), '...'))) AS n_cut
      FROM d LEFT JOIN p USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             concat_ws(', ', CASE WHEN n_words > 100000 THEN 'long texts' END,
                       CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 'word length' END,
                       CASE WHEN 10 * n_symbols > 6 * n_words THEN 'symbols' END,
                       CASE WHEN n_words >= 50 AND 100 * n_stop_words < n_words THEN 'stop words' END,
                       CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 'repeated lines' END,
                       CASE WHEN 10 * n_bullet > 9 * n_lines THEN 'bullet lines' END,
                       CASE WHEN 10 * n_cut > 3 * n_lines THEN 'unfinished lines' END) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept,
       n_lines, n_stop_words, failed_rules FROM f
"""

# crc32 by bits: every byte goes in, then eight shifts
_SQL_CRC = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
    lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END),
    4294967295), 4294967295)"""


def _sql_leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


_SQL_UP = "SELECT l + 1, g, p // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY p)) FROM {t} WHERE n > 1 GROUP BY l, g, p // 8"
_SQL_SIDES = """SELECT x.l, x.g, x.p, coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p < x.p), '') AS a,
    coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p > x.p), '') AS b
FROM {t} x JOIN {t} y ON x.l = y.l AND x.g = y.g AND x.p // 8 = y.p // 8 WHERE x.n > 1 GROUP BY x.l, x.g, x.p"""

ORACLE["op13_merkle"] = f"""
WITH RECURSIVE d AS (SELECT *, coalesce('=' || lang, '') AS g, {_SQL_CRC} % 3 = 0 AS third FROM documents),
leaf AS MATERIALIZED (SELECT doc_id, g, {_sql_leaf("text")} AS h,
    CASE WHEN third THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_sql_leaf("text")} END AS f,
    row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM d),
tree(l, g, p, n, h) AS (SELECT 0, g, p, n, h FROM leaf UNION ALL {_SQL_UP.format(t="tree")}),
subs AS (SELECT g AS of, h, row_number() OVER (ORDER BY encode(g)) - 1 AS p, count(*) OVER () AS n FROM tree WHERE n = 1),
trunk(l, g, p, n, h) AS (SELECT 0, '', p, n, h FROM subs UNION ALL {_SQL_UP.format(t="trunk")}),
low AS MATERIALIZED ({_SQL_SIDES.format(t="tree")}), high AS MATERIALIZED ({_SQL_SIDES.format(t="trunk")}),
steps AS MATERIALIZED (SELECT doc_id, l, a, b FROM leaf JOIN low ON low.g = leaf.g AND low.p = leaf.p // CAST(8 ** l AS BIGINT)
    UNION ALL SELECT doc_id, 100 + l, a, b FROM leaf JOIN subs ON subs.of = leaf.g JOIN high ON high.p = subs.p // CAST(8 ** l AS BIGINT)),
way AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l) AS k FROM steps),
folded(doc_id, k, h) AS (SELECT doc_id, 0, f FROM leaf
    UNION ALL SELECT doc_id, way.k, sha256(a || h || b) FROM folded JOIN way USING (doc_id) WHERE way.k = folded.k + 1),
ends AS (SELECT doc_id, arg_max(h, k) AS folded_root FROM folded GROUP BY doc_id),
proofs AS (SELECT doc_id, sha256(string_agg(a || b, '' ORDER BY k)) AS proof_sha256 FROM way GROUP BY doc_id),
root AS (SELECT h AS root FROM trunk WHERE n = 1)
SELECT doc_id, leaf.h AS leaf, subs.h AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaf JOIN subs ON subs.of = leaf.g JOIN ends USING (doc_id) LEFT JOIN proofs USING (doc_id), root
"""
