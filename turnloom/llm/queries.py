"""The registered queries op1 to op10 and, where SQL can state them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import planted
from .chat import repair
from .common import crc_mod, documents
from .decontam import contamination
from .langid import identify
from .lmscore import score
from .mixture import curriculum
from .neardup import near_duplicates
from .quality import judge
from .secrets import find_secrets
from .urlrules import blocked_ids, judge_urls
from .warc import read_archives, write_archives


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    return identify(documents(spark, sf_dir, "doc_id", "text", "lang"), held_out, ~held_out & F.col("doc_id").isNotNull())


def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"), k=4, percent=80)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir, "doc_id", "text"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), blocked_ids(labels))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False))
    return score(documents(spark, sf_dir, "doc_id", "text"), held_out, ~held_out & F.col("doc_id").isNotNull())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir, "doc_id", "text", "lang"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=13)


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = curriculum(documents(spark, sf_dir, "doc_id", "text", "source"), keep_text=False)
    return out.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_warc_bundles,
        op3_minhash_neardup,
        op4_chat_format,
        op5_secret_scan,
        op6_url_filter,
        op7_lm_scoring,
        op8_quality_rules,
        op9_decontamination,
        op10_curriculum_mix,
    )
}

ORACLES: dict[str, str] = {
    "op2_warc_bundles": """
        WITH p AS (SELECT page_id, coalesce(octet_length(encode(html)), 0)::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
    """,
    "op3_minhash_neardup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, p, p + least(4, len(ws)) - 1), ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS p FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
    "op8_quality_rules": r"""
        WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        wins AS (SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS p FROM w WHERE len(ws) > 2)),
        twice AS (SELECT doc_id, g FROM wins GROUP BY ALL HAVING count(*) > 1),
        spots AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(generate_series(p, p + 2)) AS spot FROM wins JOIN twice USING (doc_id, g)) GROUP BY 1),
        lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS own FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
        m AS (SELECT w.doc_id, lang, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n - lines.own, 0) AS n_dup_lines, coalesce(lines.n, 0) AS n_lines, coalesce(spots.n, 0) AS n_repeat_words
              FROM w LEFT JOIN spots USING (doc_id) LEFT JOIN lines USING (doc_id)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
        v AS (SELECT *, unnest(['symbols', 'long_words', 'dup_lines', 'repeats']) AS signal,
                unnest([n_symbols / greatest(n_words, 1), word_chars / greatest(n_words, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1)]) AS value FROM b),
        grid AS (SELECT signal, i, cutoff FROM (SELECT 'symbols' AS signal, unnest([3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1]::DOUBLE[]) AS cutoff, unnest(range(10)) AS i
            UNION ALL SELECT 'long_words', unnest([60.0, 40.0, 30.0, 24.0, 20.0, 16.0, 14.0, 12.0]::DOUBLE[]), unnest(range(8))
            UNION ALL SELECT 'dup_lines', unnest([0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]::DOUBLE[]), unnest(range(8))
            UNION ALL SELECT 'repeats', unnest([0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]::DOUBLE[]), unnest(range(7)))),
        l AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1),
        t AS (SELECT v.lang, grid.signal, i, cutoff, count(*) FILTER (WHERE quality > 0) AS n_good, count(*) FILTER (WHERE quality <= 0) AS n_bad,
                count(*) FILTER (WHERE quality > 0 AND value > cutoff) AS k_good, count(*) FILTER (WHERE quality <= 0 AND value > cutoff) AS k_bad
              FROM v JOIN l USING (doc_id) JOIN grid USING (signal) WHERE NOT base_failed GROUP BY ALL),
        p AS (SELECT *, CASE WHEN k_good > n_good * 0.005 THEN 1.0 ELSE (SELECT sum(exp(lgamma(n_good + 1.0) - lgamma(j + 1.0) - lgamma(n_good - j + 1.0) + j * ln(0.005) + (n_good - j) * ln(0.995)))
                FROM (SELECT unnest(range(100000)) AS j) WHERE j <= k_good) END AS p FROM t),
        c AS (SELECT *, max(p) OVER (PARTITION BY lang, signal ORDER BY i) <= 0.05 / (4 * (SELECT count(DISTINCT coalesce(lang, '')) FROM t)) AS certain FROM p),
        best AS (SELECT lang, signal, cutoff, row_number() OVER (PARTITION BY lang, signal ORDER BY k_bad DESC, i) AS rank FROM c WHERE certain AND n_bad > 0 AND k_bad * n_good > k_good * n_bad),
        r AS (SELECT DISTINCT v.doc_id FROM v JOIN best ON best.lang IS NOT DISTINCT FROM v.lang AND best.signal = v.signal AND rank = 1 WHERE value > cutoff)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM r) AS kept FROM b
    """,
    "op10_curriculum_mix": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
        w AS (SELECT *, [5.0, 2.0, 1.0][(place % 3 + 1)::INT]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
        f AS (SELECT *, row_number() OVER fill AS turn, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER earlier, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
              FROM w WINDOW fill AS (ORDER BY cap / weight, source NULLS LAST), earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT f.*, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * weight) END AS target
              FROM f, (SELECT min_by(level, turn) AS final FROM f WHERE level * weight <= cap)),
        r AS (SELECT d.doc_id, size, source_size, target, place % 3 AS shape, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
                CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        p AS (SELECT *, floor(least(greatest(target - epochs * source_size - start, 0), size)) AS part, CASE WHEN target > 0 THEN least(start / target, 1) ELSE 0 END AS share FROM r)
        SELECT doc_id, size, source_size, target, (epochs * size + part)::BIGINT AS taken,
            CASE WHEN size > 0 AND epochs + part > 0 THEN round(CASE shape WHEN 0 THEN 2 * share / (0.5 + sqrt(0.25 + 2 * share)) WHEN 1 THEN 2 * share / (1.5 + sqrt(2.25 - 2 * share))
                ELSE CASE WHEN share <= 0.5 THEN 2 * share / (0.5 + sqrt(0.25 + 4 * share)) ELSE 0.5 + (share - 0.5) * 2 / (1.5 + sqrt(2.25 - 4 * (share - 0.5))) END END, 9) END AS position
        FROM p
    """,
    "op9_decontamination": r"""
        WITH words AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
        w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM words),
        iw AS (SELECT DISTINCT id, s, array_to_string(list_slice(ws, p, p + s - 1), ' ') AS g FROM (SELECT id, ws, least(13, len(ws)) AS s, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS p FROM w WHERE kind = 'i' AND len(ws) > 0)),
        dw AS (SELECT id, s, p, array_to_string(list_slice(ws, p, p + s - 1), ' ') AS g FROM (SELECT id, ws, s, unnest(generate_series(1, len(ws) - s + 1)) AS p FROM w, (SELECT DISTINCT s FROM iw) WHERE kind = 'd' AND len(ws) >= s)),
        hits AS (SELECT dw.id AS doc_id, dw.p, dw.s, iw.id AS item FROM dw JOIN iw ON dw.s = iw.s AND dw.g = iw.g),
        spots AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + s - 1)) AS spot FROM hits) GROUP BY 1),
        items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT doc_id, item::VARCHAR AS item FROM hits) GROUP BY 1)
        SELECT w.id AS doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM w LEFT JOIN spots ON spots.doc_id = w.id LEFT JOIN items ON items.doc_id = w.id WHERE kind = 'd'
    """,
}

QUERIES |= planted.QUERIES
ORACLES |= planted.oracles(ORACLES["op8_quality_rules"])
