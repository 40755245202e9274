"""Queries over the whole tables for each operator, and SQL for those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import filter_audit, lattice, licenses, mixing, ngram_join, packing, pii, quality, rules, secrets, suffixes, token_store, turns

#: Key of the surrogates in these queries; a deployment names its own.
SURROGATE_KEY = "quillspark-demonstration-key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.surrogates(_table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)
    return out.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_entities"), F.array_join("pii_kinds", ",").alias("kinds"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_components(_table(spark, sf_dir, "documents"), k=5, percent=80)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op4_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_lattice_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repaired(_table(spark, sf_dir, "conversations"))


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(_table(spark, sf_dir, "documents"), length=400)


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_surrogates,
        op2_ngram_jaccard_join,
        op3_source_mixing,
        op4_length_packing,
        op5_quality_trees,
        op6_token_store,
        op7_lattice_near_duplicates,
        op8_secret_scan,
        op9_quality_rules,
        op10_license_scan,
        op11_conversation_repair,
        op12_suffix_array_dedup,
        op13_filter_interactions,
    )
}

_NGRAM_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
a AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
k AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS pos FROM a),
c AS (SELECT *, CAST([5, 2, 1][pos % 3 + 1] AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS cap FROM k),
v AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER q, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER q, 0)) AS level
  FROM c WINDOW q AS (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap <= level * weight AS full_ FROM v),
t AS (SELECT *, least(cap, CASE WHEN full_ THEN cap ELSE (SELECT level FROM f g WHERE NOT g.full_ ORDER BY g.cap / g.weight, g.pos LIMIT 1) * weight END) AS target FROM f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate FROM t),
m AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, CAST(floor(r.rate) AS BIGINT)
    + CASE WHEN CAST('0x' || substr(md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken FROM m
"""


def _license_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    templates, places, _ = licenses.tables()
    known = ", ".join(f"({t}, {quoted(name)}, {n}, {votes}, [{', '.join(map(quoted, grams))}])" for t, name, n, votes, grams in templates)
    lined = ", ".join(f"({quoted(g)}, {t}, {at})" for g, t, at in places)
    pairs = "list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])"
    return rf"""
WITH k(t, license, n, votes, grams) AS (VALUES {known}),
p(gram, t, place) AS (VALUES {lined}),
w AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[^0-9a-z]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, unnest(range(1, len(w))) - 1 AS pos, unnest({pairs.format('w')}) AS gram FROM w),
s AS (SELECT doc_id, p.t, pos - place AS start FROM g JOIN p ON p.gram = g.gram GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT votes FROM k WHERE k.t = p.t)),
v AS (SELECT doc_id, t, license, n, grams, greatest(start, 0) AS start, w[greatest(start, 0) + 1:start + n] AS v FROM s JOIN k USING (t) JOIN w USING (doc_id)),
d AS (SELECT *, list_distinct({pairs.format('v')}) AS own FROM v WHERE len(v) > 1),
m AS (SELECT *, 2.0::DOUBLE * len(list_intersect(own, grams)) / (len(own) + len(grams)) AS dice FROM d WHERE len(own) <= 1.5 * len(grams) AND len(grams) <= 1.5 * len(own)),
b AS (SELECT *, max(dice) OVER (PARTITION BY doc_id ORDER BY start RANGE BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS top FROM m WHERE dice >= 0.8),
u AS (SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id, t ORDER BY start) < n THEN 0 ELSE 1 END AS new FROM b WHERE dice = top),
c AS (SELECT doc_id, license, t, sum(new) AS units, max(dice) AS dice FROM u GROUP BY 1, 2, 3)
SELECT doc_id, license, CAST(max(units) AS BIGINT) AS n_units, round(max(dice), 6) AS dice FROM c GROUP BY 1, 2
"""


def _secret_sql(scope: int = 200) -> str:
    passes = {
        "assign": f"length(regexp_extract(t, $${secrets.ASSIGN}$$, 2)) >= 12",
        "access": "true",
        "hex": "true",
        "link_access": "regexp_matches(t, '[A-Z]') AND regexp_matches(t, '[0-9]')",
        "link_secret": "regexp_matches(t, '[A-Z]') AND regexp_matches(t, '[a-z]') AND regexp_matches(t, '[0-9]')",
        "link_endpoint": "true",
    }
    spans = []
    for i, (kind, pattern, _, role) in enumerate(secrets.KINDS):
        spans.append(
            f"SELECT doc_id, text, {i} AS k, '{kind}' AS kind, '{role}' AS role, CAST(coalesce(list_sum(list_transform(b[1:n], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:n - 1], lambda x: length(x))), 0) AS BIGINT) AS a, m[n] AS t"
            f" FROM (SELECT doc_id, text, string_split_regex(text, $${pattern}$$) AS b, m, unnest(range(1, len(m) + 1)) AS n FROM (SELECT doc_id, text, regexp_extract_all(text, $${pattern}$$, 0) AS m FROM d)) WHERE {passes[kind].replace('(t,', '(m[n],').replace('(t)', '(m[n])')}"
        )
    far = "greatest({1}.a - {0}.e, {0}.a - {1}.e)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT *, a + length(t) AS e, length(left(text, a)) - length(replace(left(text, a), chr(10), '')) AS line, len(string_split_regex(left(text, a), '{secrets.EMPTY_LINE}')) AS block FROM ({' UNION ALL '.join(spans)})),
base AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
  coalesce(string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, k), '') AS written FROM p WHERE k <= 2 GROUP BY 1),
w AS (SELECT * FROM p x WHERE k <= 2 OR NOT EXISTS (SELECT 1 FROM p y WHERE y.doc_id = x.doc_id AND y.k <= 2 AND y.a <= x.a AND y.e >= x.e)),
pairs AS (SELECT x.doc_id, x.a, x.e, x.k, y.a AS sa, y.e AS se, y.k AS sk, CASE WHEN x.line = y.line THEN 'line' WHEN x.block = y.block THEN 'block' ELSE 'near' END AS scope
  FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.role = 'access' AND y.role = 'secret' AND {far.format('x', 'y')} BETWEEN 0 AND {scope}),
ends AS (SELECT z.a AS za, z.e AS ze, z.doc_id, x.role, x.a, x.e, x.k, {far.format('x', 'z')} AS far FROM w z JOIN w x ON z.doc_id = x.doc_id AND z.role = 'endpoint' AND x.role IN ('access', 'secret') AND {far.format('x', 'z')} <= {scope}),
told AS (SELECT p.*, (SELECT min([greatest(x.far, y.far), x.za, x.ze]) FROM ends x JOIN ends y ON x.doc_id = y.doc_id AND x.za = y.za
  WHERE x.doc_id = p.doc_id AND x.role = 'access' AND x.a = p.a AND x.k = p.k AND y.role = 'secret' AND y.a = p.sa AND y.k = p.sk) AS z FROM pairs p),
links AS (SELECT doc_id, string_agg(a || '-' || e || '/' || sa || '-' || se || '/' || coalesce(z[2] || '-' || z[3], 'none') || '/' || scope, ',' ORDER BY a, k, sa, sk) AS links FROM told GROUP BY 1),
l AS (SELECT w.* FROM w WHERE k > 2 AND ((role = 'access' AND EXISTS (SELECT 1 FROM pairs p WHERE p.doc_id = w.doc_id AND p.a = w.a AND p.k = w.k))
  OR (role = 'secret' AND EXISTS (SELECT 1 FROM pairs p WHERE p.doc_id = w.doc_id AND p.sa = w.a AND p.sk = w.k))
  OR (role = 'endpoint' AND (SELECT count(DISTINCT role) FROM ends x WHERE x.doc_id = w.doc_id AND x.za = w.a) = 2))),
every AS (SELECT doc_id, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, k) AS written FROM (SELECT * FROM p WHERE k <= 2 UNION ALL SELECT * FROM l) GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b.written, '')) AS base_sha256, coalesce(v.written, '') AS spans, coalesce(links.links, '') AS links
FROM d LEFT JOIN base b ON b.doc_id = d.doc_id LEFT JOIN every v ON v.doc_id = d.doc_id LEFT JOIN links ON links.doc_id = d.doc_id
"""


#: All pairs by brute force; the lattice finds all of them where like vectors are as near as copies are.
_VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, min(r.b) AS component_id, min(r.b) = v.vec_id AS kept FROM v JOIN r ON r.a = v.vec_id GROUP BY v.vec_id
"""

_FILTER_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
m AS (SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic, CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
 + 4 * CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) AS INTEGER) + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
 + 16 * CAST(coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS mask FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT o AS filter_order, CAST(step AS INTEGER) AS step, o[step] AS f, 1 << (ascii(o[step]) - 65) AS own, CAST(coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(o[i]) - 65))), 0) AS BIGINT) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f, sum(n) FILTER (WHERE mask & (before | own) = 0) AS kept, sum(n) FILTER (WHERE mask & before = 0 AND mask & own <> 0) AS removed, sum(n) FILTER (WHERE mask & before <> 0 AND mask & own <> 0) AS redundant,
 sum(n) FILTER (WHERE mask = own) AS unique_fails, sum(good) FILTER (WHERE mask & before = 0 AND mask & own <> 0) AS good_lost, sum(toxic) FILTER (WHERE mask & before = 0 AND mask & own <> 0) AS toxic_lost FROM c, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
 CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r
"""

ORACLE_SQL = {"op2_ngram_jaccard_join": _NGRAM_SQL, "op3_source_mixing": _MIX_SQL, "op7_lattice_near_duplicates": _VECTOR_SQL, "op8_secret_scan": _secret_sql(), "op10_license_scan": _license_sql(), "op13_filter_interactions": _FILTER_SQL}
