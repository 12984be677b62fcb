"""The queries op1_ to op10_ and, where SQL can express them, their equivalents for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrix.llm import decontaminate, exact_dedup, html_text, language_id, mixture, near_dedup, secret_scan, substring_dedup, suffix_tree_lm, url_filter
from papyrix.llm.common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80).drop("set_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op4_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.bucket("doc_id", 7) == 2
    out = suffix_tree_lm.score(docs, docs.filter(~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents")).drop("repetitions")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is bad if the labels of the same number say quality 0."""
    bad = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_filter.judge(table(spark, sf_dir, "pages"), bad).drop("bad_rate", "bad_bound")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_secret_scan": op3_secret_scan,
    "op4_suffix_tree_lm": op4_suffix_tree_lm,
    "op5_html_text": op5_html_text,
    "op6_decontaminate": op6_decontaminate,
    "op7_mixture": op7_mixture,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_exact_dedup": op10_exact_dedup,
}

_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HOST = "translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '')"


_SITE = r"regexp_replace({0}, '^[^@]*@|:\d*$', '', 'g')"
_TWO_LABELS = f"({', '.join(repr(x) for x in url_filter.SUFFIXES)})"


def _last_labels(site: str, more: int) -> str:
    """The suffix and ``more`` labels before it."""
    last = lambda n: f"array_to_string(list_slice(string_split({site}, '.'), -{n}, -1), '.')"
    return f"CASE WHEN {last(2)} IN {_TWO_LABELS} THEN {last(2 + more)} ELSE {last(1 + more)} END"


def _shrunk_sql(name: str, keys: str, parents: str, on: str) -> str:
    return f"""
{name}_0 AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad FROM counts GROUP BY {keys}),
{name}_1 AS (SELECT c.*, p.mean AS prior FROM {name}_0 c JOIN {parents} p {on}),
{name}_2 AS (SELECT 1 / coalesce(least(greatest(sum(CASE WHEN n > 1 THEN n * (bad / n - prior) * (bad / n - prior) - prior * (1 - prior) END)
    / nullif(sum(CASE WHEN n > 1 THEN prior * (1 - prior) * (n - 1) END), 0), 1 / 201.0::DOUBLE), 1 / 3.0::DOUBLE), 1 / 201.0::DOUBLE) - 1 AS weight FROM {name}_1),
{name}_3 AS (SELECT {keys}, (bad + weight * prior) / (n + weight) AS mean, n + weight AS total FROM {name}_1, {name}_2)"""


ORACLES: dict[str, str] = {
    "op1_near_dedup": rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_NORMAL}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM w),
c AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM s) WHERE len(s) > 0 GROUP BY s),
e AS (SELECT rep, n, unnest(s) AS x FROM c),
p AS (SELECT a.rep AS a, b.rep AS b FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep AND least(a.n, b.n) * 100 >= 80 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT rep AS v, rep AS u FROM c UNION SELECT r.v, l.b FROM r JOIN l ON r.u = l.a),
k AS (SELECT v, min(u) AS label FROM r GROUP BY v)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(label, s.doc_id) AS component_id, s.doc_id = coalesce(label, s.doc_id) AS kept
FROM s LEFT JOIN c ON list_sort(s.s) = c.s LEFT JOIN k ON k.v = c.rep""",
    "op6_decontaminate": rf"""
WITH w AS (SELECT 'd' AS t, doc_id AS id, list_filter(regexp_split_to_array({_NORMAL}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
    UNION ALL SELECT 'i', item_id, list_filter(regexp_split_to_array({_NORMAL}, '[\x20\x09-\x0D]+'), lambda x: x <> '') FROM benchmark),
i AS (SELECT id AS item_id, least(5, len(w)) AS k, list_distinct([array_to_string(w[j:j + least(5, len(w)) - 1], ' ') FOR j IN range(1, len(w) - least(5, len(w)) + 2)]) AS s FROM w WHERE t = 'i' AND len(w) > 0),
x AS (SELECT item_id, len(s) AS n, k, unnest(s) AS x FROM i),
d AS (SELECT id AS doc_id, k, unnest(list_distinct([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)])) AS x FROM w, (SELECT DISTINCT k FROM i) WHERE t = 'd' AND len(w) >= k)
SELECT doc_id, item_id, count(DISTINCT x)::BIGINT AS shared, n::BIGINT AS n_item FROM d JOIN x USING (k, x) GROUP BY doc_id, item_id, n HAVING 100 * count(DISTINCT x) >= 80 * n""",
    "op7_mixture": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(concat_ws('|', 'mixture-1', coalesce(doc_id::VARCHAR, ''))) AS ord FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM s),
r AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT arg_min(level, ratio) AS water, min(ratio) AS first FROM l WHERE ratio > level),
t AS (SELECT source, source_size, CASE WHEN ratio >= first THEN water * weight ELSE cap END AS target FROM l LEFT JOIN f ON true),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(round(target / source_size, 9)) ELSE 0 END::BIGINT AS whole FROM t),
g AS (SELECT *, greatest(round(target - whole * source_size, 6), 0) AS rest FROM e),
j AS (SELECT d.*, source_size, target, whole, rest, substr(ord, 1, 4) AS bucket FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
b AS (SELECT source, bucket, any_value(rest) AS rest, sum(size) AS words FROM j GROUP BY source, bucket),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY bucket) - words AS below FROM b),
k AS (SELECT source, min(bucket) AS cut, arg_min(below, bucket) AS below FROM c WHERE below <= rest AND rest < below + words GROUP BY source),
x AS (SELECT j.*, cut, below FROM j LEFT JOIN k ON j.source IS NOT DISTINCT FROM k.source),
i AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ord, doc_id, size) AS rn,
    rest - below - sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) >= 0 AS inside FROM x WHERE bucket = cut),
m AS (SELECT *, rest - below - coalesce(sum(size) FILTER (inside) OVER (PARTITION BY source), 0) AS missing FROM i),
o AS (SELECT *, CASE WHEN NOT inside THEN abs(size - missing) END AS off FROM m),
q AS (SELECT source, min({'a': off, 'b': rn}) AS best FROM o WHERE off < missing GROUP BY source),
z AS (SELECT doc_id, size, source_size, target, whole + CASE WHEN inside OR coalesce(rn = best.b, false) THEN 1 ELSE 0 END AS reps FROM o LEFT JOIN q ON o.source IS NOT DISTINCT FROM q.source
    UNION ALL SELECT doc_id, size, source_size, target, whole + CASE WHEN bucket < cut THEN 1 ELSE 0 END FROM x WHERE bucket IS DISTINCT FROM cut)
SELECT doc_id, size, source_size, target, (size * reps)::BIGINT AS taken FROM z""",
    "op9_url_filter": f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
sites AS (SELECT page_id, host AS full_host, path, {_SITE.format("host")} AS host FROM p),
counts AS (SELECT host, {_last_labels("host", 1)} AS domain, {_last_labels("host", 0)} AS suffix, count(*) AS n, sum(1 - quality)::DOUBLE AS bad
    FROM sites JOIN labels ON sites.page_id = labels.doc_id WHERE quality IS NOT NULL GROUP BY ALL),
root AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS mean FROM counts),
{_shrunk_sql("sfx", "suffix", "root", "ON true")},
{_shrunk_sql("dom", "domain, suffix", "sfx_3", "USING (suffix)")},
{_shrunk_sql("hst", "host, domain", "dom_3", "USING (domain)")},
known AS (SELECT 'suffix' AS level, suffix AS name, mean, total FROM sfx_3 UNION ALL SELECT 'domain', domain, mean, total FROM dom_3 UNION ALL SELECT 'host', host, mean, total FROM hst_3),
bounds AS (SELECT level, name, mean - 1.64 * sqrt(mean * (1 - mean) / (total + 1)) AS bound FROM known),
j AS (SELECT page_id, full_host AS host, path, coalesce(h.bound, d.bound, s.bound) AS bound FROM sites p
    LEFT JOIN bounds h ON h.level = 'host' AND h.name = p.host
    LEFT JOIN bounds d ON d.level = 'domain' AND d.name = {_last_labels("p.host", 1)}
    LEFT JOIN bounds s ON s.level = 'suffix' AND s.name = {_last_labels("p.host", 0)}),
m AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM j)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM m""",
    "op10_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
}
