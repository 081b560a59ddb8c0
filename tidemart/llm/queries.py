"""The named queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, kneser_ney, merkle, mixing, pii, prefix_free, quality, simhash, spelling, token_files, toxicity, url_rules
from .oracles import MERKLE, REPEATED_PASSAGES, SPELLING
from .tables import lower_ascii, saved, table


#: A text whose score reaches this is predicted toxic.
TOXIC_FROM = 0.7


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def crc_of_id(parts: int) -> F.Column:
    """CRC-32 of the doc_id as text, modulo ``parts``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id(10) == 0
    model = kneser_ney.build(docs.filter(~held_out))
    found = kneser_ney.scored(docs, model)
    trained = F.lit(model.tokens).cast("long").alias("train_tokens")
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", trained, "base_score", "score")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judged(docs, quality.trusted_ids(labels)).select("doc_id", "__q.*")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = saved(mixing.units(table(spark, sf_dir, "documents")), "mixing-units")
    return mixing.mixture(units, saved(mixing.plan(units), "mixing-plan"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_rules.judged(table(spark, sf_dir, "pages"), url_rules.LISTED_RULES + url_rules.PATTERN_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_files(files)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.found(docs, pii.fit(docs))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(crc_of_id(3) != 1), cut=TOXIC_FROM)
    found = toxicity.scored(docs, model)
    predicted = (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    return found.select("doc_id", (crc_of_id(3) == 1).alias("held_out"), "score", predicted)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    found = merkle.proofs(table(spark, sf_dir, "documents"), tampered_text=lowered)
    hexed = {c: F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")}
    proof = F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256")
    return found.select("doc_id", hexed["leaf"], hexed["subroot"], hexed["root"], proof, hexed["folded_root"], "verified")


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_free.without_repeats(table(spark, sf_dir, "documents"), width=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), least_length=7, least_count=2)
    return spelling.variants(words, ratio=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_model": op1_language_model,
    "op2_quality_rules": op2_quality_rules,
    "op3_source_mixing": op3_source_mixing,
    "op4_url_rules": op4_url_rules,
    "op5_token_files": op5_token_files,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_personal_data": op8_personal_data,
    "op9_toxicity": op9_toxicity,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_merkle": op11_merkle,
    "op12_repeated_passages": op12_repeated_passages,
    "op13_spelling": op13_spelling,
}

UNWANTED = "|".join(url_rules.UNWANTED_HOST_WORDS)

ORACLES: dict[str, str] = {
    "op4_url_rules": f"""
        WITH p AS (
            SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM pages),
        r AS (
            SELECT *, CASE WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
                           WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
                           WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
                           WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
                           WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
            FROM p)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN regexp_matches(host, '(^|[^A-Za-z0-9])({UNWANTED})([^A-Za-z0-9]|$)') THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM r""",
    "op10_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY body)""",
    "op11_merkle": MERKLE,
    "op12_repeated_passages": REPEATED_PASSAGES,
    "op13_spelling": SPELLING,
}
