"""The corpus operators over the whole `documents` table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, exact_dedup, fingerprints, infill, language, licenses, mixing,
               near_dedup, packing, pii, resample, secret_scan, token_count)
from .common import table
from .registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]


@query("op9_exact_dedup", r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''),
                                                '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
     g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
           FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept,
       text_sha256
FROM t JOIN g USING (text_sha256)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digest(byte_bpe.round_trip(
        table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), path))


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_count.token_counts(table(spark, sf_dir, "documents"), path)


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return language.predictions(table(spark, sf_dir, "documents"), path)


@query("op3_minhash", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] ELSE list_transform(
           range(1, greatest(len(w) - 3, 1) + 1),
           lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM w),
c AS (SELECT s_key, min(doc_id) AS node, any_value(s) AS s
      FROM (SELECT doc_id, s, md5(array_to_string(list_sort(s), chr(10))) AS s_key FROM s
            WHERE len(s) > 0) GROUP BY s_key),
e AS (SELECT node, len(s) AS n, unnest(s) AS x FROM c),
l AS (SELECT a.node AS a, b.node AS b FROM e a JOIN e b ON a.x = b.x AND a.node < b.node
      GROUP BY a.node, b.node
      HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT node AS a, node AS b FROM c WHERE node IN (SELECT a FROM u)
      UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
p AS (SELECT a AS node, min(b) AS part FROM r GROUP BY a),
k AS (SELECT s.doc_id, len(s.s) AS n_shingles,
             CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE coalesce(p.part, c.node) END AS component_id
      FROM s LEFT JOIN c ON c.s_key = md5(array_to_string(list_sort(s.s), chr(10)))
             LEFT JOIN p ON p.node = c.node)
SELECT doc_id, n_shingles, component_id,
       coalesce(doc_id = component_id, component_id IS NULL) AS kept FROM k""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), words=4)


@query("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query("op5_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(table(spark, sf_dir, "documents")))


def _template_rows() -> str:
    def listed(values):
        return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"

    return ", ".join(f"({k}, '{name}', '{text.replace(chr(39), chr(39) * 2)}', {listed(marks)})"
                     for k, (name, marks, text) in enumerate(licenses.TEMPLATES))


def _sql_words(text: str) -> str:
    return (f"list_filter(string_split(lower(regexp_replace({text}, '[^A-Za-z0-9]+', ' ', 'g')), "
            "' '), lambda x: x <> '')")


@query("op7_licenses", f"""
WITH v(id, name, txt, marks) AS (VALUES {_template_rows()}),
tw AS (SELECT id, name, {_sql_words("txt")} AS w FROM v),
tp AS (SELECT id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
       FROM tw),
mw AS (SELECT id, {_sql_words("m")} AS w FROM (SELECT id, unnest(marks) AS m FROM v)),
mk AS (SELECT DISTINCT id, b FROM (SELECT id, unnest(list_transform(range(1, len(w)),
              lambda i: w[i] || ' ' || w[i + 1])) AS b FROM mw)),
tb AS (SELECT id, b, (id, b) IN (SELECT (id, b) FROM mk) AS marked
       FROM (SELECT DISTINCT id, b FROM tp)),
tm AS (SELECT id, count(*) AS m, count(*) FILTER (marked) AS marks FROM tb GROUP BY id),
ts AS (SELECT id, count(*) AS s FROM tp GROUP BY id
       UNION SELECT id, CAST(floor(m * 1.5) AS BIGINT) FROM tm),
d AS (SELECT doc_id, row_number() OVER () AS r, {_sql_words("coalesce(text, '')")} AS w
      FROM documents),
p AS (SELECT r, i, w[i] || ' ' || w[i + 1] AS b
      FROM (SELECT r, w, unnest(range(1, greatest(len(w), 1))) AS i FROM d)),
h AS (SELECT r, id, i, b, marked FROM p JOIN tb USING (b)),
sp AS (SELECT DISTINCT h.r, h.id, h.i AS first, max(g.i) AS last
       FROM h JOIN ts ON ts.id = h.id
       JOIN h g ON g.r = h.r AND g.id = h.id AND g.i >= h.i AND g.i < h.i + ts.s
       JOIN tm ON tm.id = h.id
       GROUP BY h.r, h.id, h.i, ts.s, m, tm.marks
       HAVING 3 * count(DISTINCT g.b) >= 2 * m
          AND count(DISTINCT g.b) FILTER (g.marked) = tm.marks),
un AS (SELECT sp.r, sp.id, first, last, count(DISTINCT p.b) AS n,
              count(DISTINCT p.b) FILTER ((sp.id, p.b) IN (SELECT (id, b) FROM tb)) AS shared
       FROM sp JOIN p ON p.r = sp.r AND p.i BETWEEN first AND last
       GROUP BY sp.r, sp.id, first, last),
di AS (SELECT r, id, first, last, 2.0::DOUBLE * shared / (n + m) AS dice FROM un JOIN tm USING (id)),
be AS (SELECT * FROM di WHERE dice >= 0.8 QUALIFY row_number() OVER (
           PARTITION BY r, id ORDER BY dice DESC, first, last) = 1),
ke AS (SELECT r, name, max(dice) AS dice FROM be x JOIN v USING (id)
       WHERE NOT EXISTS (SELECT 1 FROM be y WHERE y.r = x.r AND y.dice > x.dice
                                              AND y.first <= x.last AND x.first <= y.last)
       GROUP BY r, name)
SELECT d.doc_id, count(ke.name) AS n_licenses,
       coalesce(string_agg(ke.name, ',' ORDER BY ke.name), '') AS licenses,
       coalesce(max(ke.dice), 0.0::DOUBLE) AS best_dice
FROM d LEFT JOIN ke ON ke.r = d.r GROUP BY d.r, d.doc_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents")))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.entities(table(spark, sf_dir, "documents")))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_resample", rf"""
WITH bits AS (SELECT i AS x, list_reduce([i] || range(8), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
              FROM range(256) r(i)),
crc_of AS (SELECT list(t ORDER BY x) AS t FROM bits),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")},
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
e AS (SELECT r, unnest(w) AS w FROM d),
words AS (SELECT w FROM e UNION SELECT w FROM b),
hexed AS (SELECT w, hex(encode(w)) AS h FROM words),
crc AS (SELECT w, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda i:
                 (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16
                 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1),
                 lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
        FROM hexed, crc_of),
s AS (SELECT bucket, count(*) AS n FROM e JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN crc USING (w) GROUP BY bucket),
g AS (SELECT k AS bucket, CAST(floor(1000 * ln(
             ((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000))
             / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000))))
             AS BIGINT) AS gain
      FROM range(10000) r(k) LEFT JOIN s ON s.bucket = k LEFT JOIN t ON t.bucket = k),
v AS (SELECT r, sum(gain) AS weight FROM e JOIN crc USING (w) JOIN g USING (bucket) GROUP BY r),
h AS (SELECT d.r, doc_id, len(w) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
      FROM d LEFT JOIN v ON v.r = d.r),
c AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT)
                AS score FROM h),
p AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM c WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <=
         (SELECT 10 * count(*) // 100 FROM p) THEN rank END AS rank
FROM c LEFT JOIN p USING (r)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_mixing", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''),
             '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || sha256('1:' || coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
n AS (SELECT count(*) AS n, sum(source_size) * 1.5::DOUBLE AS words FROM s),
-- shares by weight of what the capped sources leave, until none is above its cap
r AS (SELECT 0 AS step, source, source_size, w, false AS capped FROM s
      UNION ALL
      SELECT step + 1, source, source_size, w, capped OR
             (words - sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER ()) * w
             / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () > 2 * source_size
      FROM r, n WHERE step <= n),
l AS (SELECT * FROM r WHERE step = (SELECT max(step) FROM r)),
t AS (SELECT source, source_size, CASE WHEN capped THEN (2 * source_size)::DOUBLE ELSE
             (words - sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER ()) * w
             / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target
      FROM l, n),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             least(floor(t.target + 0.5), 2 * t.source_size)::BIGINT AS goal,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                               ROWS UNBOUNDED PRECEDING) - d.size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, goal - start))
        + greatest(0, least(size, goal - source_size - start)))::BIGINT AS taken
FROM o""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(*mixing.mix(table(spark, sf_dir, "documents")))


@query("op13_infill", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
             ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>')
                       OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = infill.round_trip(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))
