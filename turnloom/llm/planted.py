"""Queries over planted rows, derived from all rows of a table, on which the methods of op5, op6 and op8 decide.

On the tables themselves few credentials lie near each other, labels don't follow URLs, and a stratum has
few labels; each query here has the operator, with its production parameters, meet what it is made for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .quality import judge
from .secrets import find_secrets
from .urlrules import judge_urls


def planted_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with parts of a credential behind it, by doc_id mod 4: identifier and secret; a secret alone; these two
    and an endpoint; identifier and secret too far apart."""
    h = F.md5(F.col("doc_id").cast("string"))
    identifier, secret = F.concat(F.lit("ZX"), F.upper(F.substring(h, 1, 18))), F.concat(F.substring(h, 1, 20), F.upper(F.substring(h, 13, 20)))
    form = F.pmod(F.col("doc_id"), F.lit(4))
    more = (
        F.when(form == 0, F.concat(identifier, F.lit(" with "), secret)).when(form == 1, secret).when(form == 2, F.concat(identifier, F.lit("\n"), secret, F.lit(" at https://api.example.com/v1")))
        .otherwise(F.concat(identifier, F.repeat(F.lit(" pad"), F.lit(150)), F.lit(" "), secret))
    )
    far = F.repeat(F.lit(" ."), F.lit(150))
    return find_secrets(documents(spark, sf_dir, "doc_id", "text").withColumn("text", F.concat(F.coalesce("text", F.lit("")), far, F.lit(" "), more)))


def planted_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page labelled by its own URL: a host, and a combination of a host suffix and a path segment, are to be blocked."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    url = F.coalesce("url", F.lit(""))
    bad = url.contains("spam-farm") | (url.contains(".example.org/") & url.contains("/en/"))
    return judge_urls(pages, pages.select(F.col("page_id").cast("bigint").alias("page_id"), bad.cast("int").alias("blocked")))


def planted_quality_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text of 60 words by event, its language the event's type; a sixth of them have symbols and are labelled bad."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    bad = F.col("event_id") % 6 == 0
    word = lambda i: F.concat(F.when(bad & (i % 2 == 0), F.lit("#")).otherwise(F.lit("w")), i.cast("string"))
    docs = rows.select(F.col("event_id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), word), " ").alias("text"), F.col("event_type").alias("lang"))
    return judge(docs, rows.select(F.col("event_id").alias("doc_id"), (~bad).cast("int").alias("quality")))


QUERIES = {f.__name__: f for f in (planted_secret_links, planted_url_rules, planted_quality_cutoffs)}

#: op5: matches with their offsets from the gaps between them; weak kinds as maximal runs, which are then tested.
SECRETS_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
    kinds AS (SELECT * FROM (VALUES (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'), (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'),
        (3, 'key_id', '[A-Za-z0-9]+'), (4, 'secret', '[A-Za-z0-9+/_=-]+'), (5, 'endpoint', '(?i)https?://[A-Za-z0-9.-]+[^\x00-\x20"''<>]*')) t(rank, kind, pattern)),
    lists AS (SELECT uid, 0 AS rank, regexp_extract_all(text, (SELECT pattern FROM kinds WHERE rank = 0)) AS found, regexp_split_to_array(text, (SELECT pattern FROM kinds WHERE rank = 0)) AS gaps FROM d
        UNION ALL SELECT uid, 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_split_to_array(text, 'AKIA[A-Z0-9]+') FROM d
        UNION ALL SELECT uid, 2, regexp_extract_all(text, '[0-9a-f]+'), regexp_split_to_array(text, '[0-9a-f]+') FROM d
        UNION ALL SELECT uid, 3, regexp_extract_all(text, '[A-Za-z0-9]+'), regexp_split_to_array(text, '[A-Za-z0-9]+') FROM d
        UNION ALL SELECT uid, 4, regexp_extract_all(text, '[A-Za-z0-9+/_=-]+'), regexp_split_to_array(text, '[A-Za-z0-9+/_=-]+') FROM d
        UNION ALL SELECT uid, 5, regexp_extract_all(text, (SELECT pattern FROM kinds WHERE rank = 5)), regexp_split_to_array(text, (SELECT pattern FROM kinds WHERE rank = 5)) FROM d),
    each AS (SELECT uid, rank, i, found[i] AS m, length(gaps[i]) AS gap FROM (SELECT *, unnest(generate_series(1, len(found))) AS i FROM lists WHERE len(found) > 0)),
    placed AS (SELECT uid, rank, m, sum(gap + length(m)) OVER (PARTITION BY uid, rank ORDER BY i) AS e FROM each),
    s AS (SELECT uid, rank, (e - length(m))::BIGINT AS s, e::BIGINT AS e FROM placed WHERE CASE rank
        WHEN 0 THEN length(regexp_extract(m, (SELECT pattern FROM kinds WHERE rank = 0), 2)) >= 8 WHEN 1 THEN length(m) >= 16 WHEN 2 THEN length(m) >= 32
        WHEN 3 THEN regexp_full_match(m, '[A-Z0-9]{16,}') AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]')
        WHEN 4 THEN regexp_full_match(m, '[A-Za-z0-9+/_-]{24,}={0,2}') AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') ELSE true END),
    near AS (SELECT w.uid, w.rank, w.s, w.e, bool_or(p.rank IN (1, 3)) AS id, bool_or(p.rank IN (0, 2, 4)) AS key, bool_or(p.rank = 5) AS place, bool_or(p.rank < 3 AND p.s < w.e AND p.e > w.s) AS covered
        FROM s w JOIN s p ON p.uid = w.uid AND p.s <= w.e + 256 AND p.e >= w.s - 256 AND (p.s <> w.s OR p.rank <> w.rank) WHERE w.rank >= 3 GROUP BY ALL),
    chosen AS (SELECT uid, rank, s, e FROM s WHERE rank < 3 UNION ALL SELECT uid, rank, s, e FROM near WHERE NOT covered AND CASE rank WHEN 3 THEN key WHEN 4 THEN id OR place ELSE id AND key END),
    named AS (SELECT uid, rank, s, kind || ':' || s || ':' || e AS span FROM chosen JOIN kinds USING (rank)),
    spans_of AS (SELECT uid, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
        coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (WHERE rank < 3), '') AS base, string_agg(span, ',' ORDER BY s, rank) AS spans FROM named GROUP BY 1)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN spans_of USING (uid)
"""
_PLANTED_SECRETS = """(SELECT doc_id, coalesce(text, '') || repeat(' .', 150) || ' ' || CASE doc_id % 4 WHEN 0 THEN id || ' with ' || secret WHEN 1 THEN secret
    WHEN 2 THEN id || chr(10) || secret || ' at https://api.example.com/v1' ELSE id || repeat(' pad', 150) || ' ' || secret END AS text
    FROM (SELECT doc_id, text, 'ZX' || upper(substr(md5(doc_id::VARCHAR), 1, 18)) AS id, substr(md5(doc_id::VARCHAR), 1, 20) || upper(substr(md5(doc_id::VARCHAR), 13, 20)) AS secret FROM documents))"""

#: op6: all frequent token sets of labelled pages grown token by token; `bad` has (page_id, blocked).
URL_SQL = r"""
    WITH RECURSIVE bad AS ({bad}),
    u AS (SELECT row_number() OVER () AS uid, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
    p AS (SELECT uid, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path, substr(rest, length(raw) + length(path) + 1) AS tail, rest FROM h),
    q AS (SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS segments, regexp_replace(regexp_extract(tail, '^[^#]*'), '^\?', '') AS query, contains(tail, '#') AND NOT ends_with(tail, '#') AS fragment FROM p),
    t AS (SELECT uid, 'host=' || array_to_string(list_slice(labels, i, len(labels)), '.') AS t FROM (SELECT *, unnest(generate_series(1, len(labels))) AS i FROM q WHERE rest <> '')
        UNION ALL SELECT uid, 'path=' || unnest(segments) FROM q UNION ALL SELECT uid, 'ext=' || regexp_extract(segments[-1], '[^.]*$') FROM q WHERE contains(segments[-1], '.')
        UNION ALL SELECT uid, 'key=' || string_split(k, '=')[1] FROM (SELECT uid, unnest(list_filter(string_split(query, '&'), lambda x: x <> '')) AS k FROM q) UNION ALL SELECT uid, 'fragment' FROM q WHERE fragment),
    tokens AS (SELECT DISTINCT uid, regexp_replace(t, '[0-9]+', '#', 'g') AS t FROM t),
    known AS (SELECT uid, blocked AS b FROM u JOIN bad USING (page_id)),
    size AS (SELECT count(*) AS n, coalesce(sum(b), 0) AS b FROM known),
    sig AS (SELECT t, string_agg(uid, ',' ORDER BY uid) AS who FROM tokens JOIN known USING (uid) GROUP BY t HAVING sum(b) >= 0.002 * (SELECT n FROM size)),
    same AS (SELECT t, min(t) OVER (PARTITION BY who) AS rep FROM sig),
    held AS (SELECT DISTINCT uid, rep AS t FROM tokens JOIN same USING (t)),
    items AS (SELECT uid, t, b FROM held JOIN known USING (uid)),
    -- by Wilson's bound no rule passes on fewer than 9 blocked pages
    least AS (SELECT greatest(ceil(0.002 * (SELECT count(*) FROM known WHERE b = 1 OR uid IN (SELECT uid FROM held))), 9) AS m),
    g AS (SELECT [t] AS s, t AS last, uid, b FROM items QUALIFY sum(b) OVER (PARTITION BY t) >= (SELECT m FROM least)
        UNION ALL (SELECT list_append(g.s, i.t), i.t, g.uid, g.b FROM g JOIN items i ON i.uid = g.uid AND i.t > g.last QUALIFY sum(g.b) OVER (PARTITION BY list_append(g.s, i.t)) >= (SELECT m FROM least))),
    rules AS (SELECT s, count(*)::DOUBLE AS n, sum(b) / count(*)::DOUBLE AS c FROM g GROUP BY s),
    good AS (SELECT s, len(s) AS needs, row_number() OVER () AS rule FROM rules
        WHERE (c + 9 / (2 * n) - 3 * sqrt(c * (1 - c) / n + 9 / (4 * n * n))) / (1 + 9 / n) >= 0.6 AND c >= 0.6 AND c >= 1.2 * (SELECT b / n::DOUBLE FROM size)),
    fired AS (SELECT DISTINCT uid FROM (SELECT uid, rule, needs FROM held JOIN (SELECT rule, needs, unnest(s) AS t FROM good) USING (t) GROUP BY ALL HAVING count(*) = needs)),
    fixed AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) f(rh, rp, says)),
    best AS (SELECT uid, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(says, length(rh || rp)) AS says FROM p, fixed WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY uid)
    SELECT page_id, host, path, rule, coalesce(says, CASE WHEN fired.uid IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, fired.uid IS NOT NULL AS mined FROM p LEFT JOIN best USING (uid) LEFT JOIN fired ON fired.uid = p.uid
"""
BAD = "SELECT doc_id AS page_id, max((coalesce(toxic, 0) > 0 OR coalesce(quality, 1) < 1)::INT) AS blocked FROM labels WHERE doc_id IS NOT NULL GROUP BY 1"
_PLANTED_BAD = "SELECT page_id, (contains(coalesce(url, ''), 'spam-farm') OR (contains(coalesce(url, ''), '.example.org/') AND contains(coalesce(url, ''), '/en/')))::INT AS blocked FROM pages"

_PLANTED_DOCS = "(SELECT event_id AS doc_id, event_type AS lang, array_to_string(list_transform(range(1, 61), lambda i: CASE WHEN event_id % 6 = 0 AND i % 2 = 0 THEN '#' ELSE 'w' END || i), ' ') AS text FROM events)"
_PLANTED_LABELS = "(SELECT event_id AS doc_id, (event_id % 6 <> 0)::INT AS quality FROM events)"


def oracles(quality_sql: str) -> dict[str, str]:
    """The SQL of op5 and op6, and that of the planted queries."""
    return {
        "op5_secret_scan": SECRETS_SQL,
        "op6_url_filter": URL_SQL.replace("{bad}", BAD),
        "planted_secret_links": SECRETS_SQL.replace("FROM documents", f"FROM {_PLANTED_SECRETS}", 1),
        "planted_url_rules": URL_SQL.replace("{bad}", _PLANTED_BAD),
        "planted_quality_cutoffs": quality_sql.replace("FROM documents", f"FROM {_PLANTED_DOCS}").replace("FROM labels", f"FROM {_PLANTED_LABELS}"),
    }
