"""The operators applied to the given tables: one query per operator, and the pipeline.

Each takes (spark, directory of the tables) and returns the operator's whole result with production
parameters. Those with plain results have an SQL twin. Hashes, trained models and merge ranks are outside DuckDB's SQL,
so the others are tested against a brute-force version, the library or held-out accuracy (tests/llm).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import work_root
from . import (
    bpe_codec, collocations, decontaminate, html_crf, language, lz_fingerprint, permuterm, quality, sharding, simhash,
    token_count, training_order, url_cascade,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.main_texts(table(spark, sf_dir, "pages"), html_crf.train())


def op2_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.with_next(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.regions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encoded_digests(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.predict(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(table(spark, sf_dir, "documents"), f"{work_root(spark)}/training-order")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op11_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_cascade.RULES), "verdict string, rule string")
    return url_cascade.judged(table(spark, sf_dir, "pages"), rules)


def op12_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.spelling_variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_html_crf": op1_html_crf,
    "op2_lz_fingerprint": op2_lz_fingerprint,
    "op3_decontamination": op3_decontamination,
    "op4_token_count": op4_token_count,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_training_order": op8_training_order,
    "op9_language": op9_language,
    "op10_sharding": op10_sharding,
    "op11_url_cascade": op11_url_cascade,
    "op12_permuterm": op12_permuterm,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

_LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE_SQL: dict[str, str] = {
    "op11_url_cascade": f"""
        WITH rules(verdict, rule_host, rule_path) AS (VALUES
            {", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in url_cascade.RULES)}),
        p AS (SELECT page_id,
                translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_LOW}) AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        fits AS (SELECT p.*, rule_host || rule_path AS rule, verdict,
                row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS n
            FROM p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                AND starts_with(path, rule_path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1""",
    "op13_collocations": rf"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), {_LOW}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        words AS (SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[\x20\x09]+') IF w <> ''] AS w FROM pieces),
        grams AS (SELECT lang, k AS size,
                unnest([array_to_string(w[i + 1 : i + k], ' ') FOR i IN range(0, len(w) - k + 1)]) AS phrase
            FROM words, range(1, 6) AS sizes(k)),
        f AS (SELECT lang, phrase, size, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
        totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
        cuts AS (SELECT f.*, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS first,
                array_to_string(string_split(phrase, ' ')[k + 1 : ], ' ') AS rest FROM f, range(1, 5) AS cut(k) WHERE k < size),
        rated AS (SELECT cuts.lang, cuts.phrase, cuts.size, cuts.a, x.a AS l, y.a AS r, n, k,
                (1000::HUGEINT * cuts.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
            FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
                JOIN totals ON totals.lang = cuts.lang),
        best AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (SELECT lang, a, size, string_split(phrase, ' ') AS w FROM f WHERE size > 2),
        inner_ AS (SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(a) AS longest
            FROM longer, range(2, 5) AS sizes(k), range(1, 5) AS places(i) WHERE k < size AND i <= size - k + 1 GROUP BY 1, 2),
        own AS (SELECT best.* FROM best LEFT JOIN inner_ USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 100 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
            n::BIGINT AS n, score::BIGINT AS score FROM own QUALIFY rank <= 2000""",
}
