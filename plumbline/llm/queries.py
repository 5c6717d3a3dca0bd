"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import (
    exact_dedup,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    phrases,
    quality_rules,
    secret_scan,
    sharding,
    spelling,
    token_index,
    toxicity,
)
from plumbline.llm.common import documents


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index.addressed_documents(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), ids=False)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = mixing.mix(mixing.sized_rows(documents(spark, sf_dir)))
    per = stream.groupBy("row_id", "doc_id", "size", "source_size", "target").agg(F.sum("taken").alias("taken"))
    return per.select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicated_lines(documents(spark, sf_dir))
    return out.select("doc_id", "text", F.col("__lines_removed").alias("n_removed"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir), keep="largest")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir), width=4)


def op11_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(documents(spark, sf_dir), shards=8)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_index,
        op2_quality_rules,
        op3_best_fit_packing,
        op4_source_mixing,
        op5_toxicity,
        op6_line_dedup,
        op7_secret_scan,
        op8_exact_dedup,
        op9_license_scan,
        op10_near_dedup,
        op11_kd_sharding,
        op12_spelling_variants,
        op13_phrase_mining,
    )
}

_WORDS = r"[^\x20\x09-\x0D]+"

SQL = {
    "op4_source_mixing": rf"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size FROM documents
        ), per AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM per
        ), filled AS (
            SELECT *, row_number() OVER o AS place,
                   (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
            FROM levels WINDOW o AS (ORDER BY full_at, source NULLS LAST)
        ), targets AS (
            SELECT source, source_size,
                   coalesce(least(2.0::DOUBLE * source_size, weight * (SELECT arg_min(level, place) FROM filled WHERE full_at > level)),
                            2.0::DOUBLE * source_size) AS target
            FROM filled
        ), served AS (
            SELECT s.*, t.source_size, t.target, e.epoch, md5('mix:' || e.epoch || ':' || doc_id) AS draw
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) e(epoch)
        ), queued AS (
            SELECT *, greatest(0, least(size, floor(target)::BIGINT - coalesce(sum(size) OVER (
                PARTITION BY source ORDER BY epoch, draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS given
            FROM served
        )
        SELECT doc_id, size, source_size, target, sum(given)::BIGINT AS taken
        FROM queued GROUP BY doc_id, size, source_size, target""",
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op13_phrase_mining": r"""
        WITH pieces AS (
          SELECT doc_id, lang, list_filter(list_transform(string_split_regex(text, '[.,;:!?\x0A-\x0D]'), lambda p: regexp_extract_all(p, '[^\x20\x09]+')), lambda w: len(w) > 0) AS ps
          FROM (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
        ), each AS (SELECT lang, unnest(ps) AS w FROM pieces
        ), grams AS (
          SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM each, (VALUES (1), (2), (3)) t(k)
        ), f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL
        ), cand AS (
          SELECT lang, k, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE k > 1 AND n >= 10
        ), cuts AS (
          SELECT c.lang, c.phrase, c.a, c.k, j, x.n AS l, y.n AS r, (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
          FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
          JOIN f x ON x.lang = c.lang AND x.k = c.j AND x.phrase = array_to_string(c.w[1:c.j], ' ')
          JOIN f y ON y.lang = c.lang AND y.k = c.k - c.j AND y.phrase = array_to_string(c.w[c.j + 1:c.k], ' ')
        ), scored AS (
          SELECT lang, phrase, k, a, unnest(arg_min(struct_pack(l := l, r := r, score := score), struct_pack(s := score, j := j))) FROM cuts GROUP BY lang, phrase, k, a
        ), longer AS (
          SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase FROM cand, (VALUES (1), (2)) t(i) WHERE k = 3) GROUP BY ALL
        ), ranked AS (
          SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
          FROM scored s LEFT JOIN longer m USING (lang, phrase) WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a
        )
        SELECT lang, rank, phrase, a, l, r, t.n AS n, score::BIGINT AS score
        FROM ranked JOIN (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang) t USING (lang) WHERE rank <= 2000""",
}
