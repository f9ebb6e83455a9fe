"""One registered query per operator, each over its whole tables, and answers in SQL where SQL can.

The SQL runs in another engine on the same tables and uses other ways than the operators.
Queries without an answer are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (
    byte_bpe,
    exact_dedup,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    packing,
    prefix_trie,
    quality,
    shingle_join,
    suffix_dedup,
    token_counts,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.mix(read(spark, folder, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op2_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.shingle_components(read(spark, folder, "documents"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, folder, "documents")).drop("spans", "kept")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rate_documents(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(read(spark, folder, "documents"), words=line_dedup.WORDS)
    return kept.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.new_folder(spark)
    warc.write_warc(read(spark, folder, "pages"), archive)
    return warc.read_warc(spark, archive)


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(read(spark, folder, "documents"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, folder, "documents"), exact_dedup.new_index(spark))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    proved = merkle.prove(merkle.build(read(spark, folder, "documents"), tampered))
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, folder, "conversations"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = byte_bpe.encode(read(spark, folder, "documents")).withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = byte_bpe.decode(encoded, keep=("doc_id", "n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("data", 256).alias("decoded_sha256"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP1 = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
levels AS (
  SELECT (SELECT sum(source_size) - 3 * coalesce(sum(source_size) FILTER (source_size / weight < a.cap), 0) FROM s)
       / (SELECT sum(weight) FILTER (source_size / weight >= a.cap) FROM s) AS level
  FROM (SELECT DISTINCT source_size / weight AS cap FROM s) a),
t AS (SELECT source, source_size, least(3 * source_size, weight * (SELECT max(level) FROM levels)) AS target FROM s),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k,
    CAST('0x' || substr(md5('mix' || coalesce(':' || d.source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(size * (floor(rate)
  + floor(u + (rate - floor(rate)) * k) - floor(u + (rate - floor(rate)) * (k - 1))) AS BIGINT) AS taken
FROM r
"""

OP2 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(1, len(words) - 4)),
    lambda i: list_aggregate(words[i + 1 : i + 5], 'string_agg', ' '))) AS shingle FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
r(doc_id, component) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.component FROM r JOIN e ON e.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(component) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

OP6 = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents),
k AS (
  SELECT *, row_number() OVER w AS k, lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
p AS (
  SELECT doc_id, k, 3 AS size, [line, line2, line3] AS part FROM k WHERE line3 IS NOT NULL
  UNION ALL SELECT a.doc_id, a.k, 2, [a.line, b.line] FROM k a JOIN k b ON b.doc_id = a.doc_id AND b.k = a.k + 1 WHERE a.n + b.n >= 50
  UNION ALL SELECT doc_id, k, 1, [line] FROM k WHERE n >= 50),
s AS (SELECT doc_id, k, size, row_number() OVER (PARTITION BY part ORDER BY doc_id, k) > 1 AS again FROM p),
m AS (
  SELECT k.doc_id, k.k, k.place, bool_or(coalesce(s.again, false)) AS gone
  FROM k LEFT JOIN s ON s.doc_id = k.doc_id AND k.k BETWEEN s.k AND s.k + s.size - 1 GROUP BY ALL),
runs AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY k), false) AS begins FROM m),
t AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) FILTER (NOT coalesce(m.gone, false)) AS kept
  FROM l LEFT JOIN m ON m.doc_id = l.doc_id AND m.place = l.place GROUP BY l.doc_id)
SELECT d.doc_id, CAST(count(runs.k) AS BIGINT) AS n_lines, CAST(count(*) FILTER (runs.gone) AS BIGINT) AS n_removed,
  CAST(count(*) FILTER (runs.begins) AS BIGINT) AS n_runs, sha256(coalesce(any_value(t.kept), '')) AS kept_sha256
FROM documents d LEFT JOIN runs ON runs.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP7 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex, strlen(coalesce(html, '')) AS n FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31
    AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM p WINDOW w AS (PARTITION BY payload)
"""

OP10 = """
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
  sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW w AS (PARTITION BY body)
"""

#: CRC-32 of a decimal number, bit by bit.
CRC = """xor(4294967295, list_reduce(list_transform(string_split(CAST({} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, x: list_reduce(range(8), lambda b, k: xor(b >> 1, 3988292384 * (b & 1)), xor(c, x)), CAST(4294967295 AS BIGINT)))"""


def leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    shown = (f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields)
    return f"sha256({' || '.join(shown)})"


OP11 = f"""
WITH RECURSIVE t AS (
  SELECT *, CASE WHEN {CRC.format("doc_id")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown FROM documents),
d AS (SELECT doc_id, source, {leaf_sql("text")} AS leaf, {leaf_sql("shown")} AS claim FROM t),
r AS (
  SELECT *, row_number() OVER () AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS place, count(*) OVER (PARTITION BY source) AS n
  FROM d),
low(tree, level, place, n, hash) AS (
  SELECT tree, 0, place, n, leaf FROM r
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
  FROM low WHERE n > 1 GROUP BY tree, level, place // 3, n),
top(level, place, n, hash) AS (
  SELECT 0, tree, count(*) OVER (), hash FROM low WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
  FROM top WHERE n > 1 GROUP BY level, place // 3, n),
folded(id, tree, level, place, n, hash, proof) AS (
  SELECT id, tree, 0, place, n, claim, '' FROM r
  UNION ALL
  SELECT f.id, f.tree, f.level + 1, f.place // 3, (f.n + 2) // 3,
    sha256(string_agg(CASE WHEN l.place = f.place THEN f.hash ELSE l.hash END, '' ORDER BY l.place)),
    f.proof || coalesce(string_agg(l.hash, '' ORDER BY l.place) FILTER (l.place <> f.place), '')
  FROM folded f JOIN low l ON l.tree = f.tree AND l.level = f.level AND l.place // 3 = f.place // 3
  WHERE f.n > 1 GROUP BY f.id, f.tree, f.level, f.place, f.n, f.hash, f.proof),
whole(id, level, place, n, hash, proof) AS (
  SELECT id, 0, tree, (SELECT max(n) FROM top), hash, proof FROM folded WHERE n = 1
  UNION ALL
  SELECT f.id, f.level + 1, f.place // 3, (f.n + 2) // 3,
    sha256(string_agg(CASE WHEN l.place = f.place THEN f.hash ELSE l.hash END, '' ORDER BY l.place)),
    f.proof || coalesce(string_agg(l.hash, '' ORDER BY l.place) FILTER (l.place <> f.place), '')
  FROM whole f JOIN top l ON l.level = f.level AND l.place // 3 = f.place // 3
  WHERE f.n > 1 GROUP BY f.id, f.level, f.place, f.n, f.hash, f.proof)
SELECT r.doc_id, r.leaf, s.hash AS subroot, t.hash AS root, sha256(w.proof) AS proof_sha256, w.hash AS folded_root,
  w.hash = t.hash AS verified
FROM r JOIN low s ON s.tree = r.tree AND s.n = 1 JOIN top t ON t.n = 1 JOIN whole w ON w.id = r.id AND w.n = 1
"""

OP12 = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC.format("conv_id")} % 9 AS h FROM t GROUP BY conv_id),
b AS (
  SELECT c.conv_id, o.k AS place, o.digest, strlen(o.text) AS size FROM c JOIN o ON o.conv_id = c.base AND o.k <= c.h
  UNION ALL
  SELECT c.conv_id, c.h + o.k, o.digest, strlen(o.text) FROM c JOIN o ON o.conv_id = c.conv_id AND o.k > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS path, size
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM c),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS value,
    left(path, 64 * (depth - 1)) AS above
  FROM p GROUP BY path, depth),
k AS (SELECT above, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above),
u AS (
  SELECT p.path, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum(n.value) AS saved_tokens
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN k ON k.above = n.path GROUP BY p.path),
l AS (SELECT conv_id, arg_max(path, depth) AS path FROM p GROUP BY conv_id),
e AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM l GROUP BY path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n LEFT JOIN n a ON n.depth > 0 AND a.path = n.above LEFT JOIN k ON k.above = n.path
JOIN u ON u.path = n.path LEFT JOIN e ON e.path = n.path
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": OP1,
        "op2_shingle_join": OP2,
        "op6_line_dedup": OP6,
        "op7_warc": OP7,
        "op10_exact_dedup": OP10,
        "op11_merkle_manifest": OP11,
        "op12_prefix_trie": OP12,
    }
