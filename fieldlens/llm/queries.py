"""The registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm import alignment, ann, decontaminate, exact, gru, langid, licenses, mixing, oracles, pii, simhash, trie, warc, wrappers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == fold


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("text_key")


def op2_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest(_table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score", "prefix", "scored")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs, ~_fold("doc_id", 4, 2))
    flagged = docs.withColumn("held_out", F.coalesce(_fold("doc_id", 4, 2), F.lit(False)))
    return langid.predict(flagged, model, ["doc_id", "held_out"])


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), share=0.8, words=5)
    return found.select("doc_id", "item_id", "n_shingles", "containment")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(_table(spark, sf_dir, "pages"))


def op7_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(warc.captures_of(_table(spark, sf_dir, "pages")), ["payload_md5", "payload_chars"])
    listed = F.array_join(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.withColumn("headers", listed)


def op8_recurrent_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru.score(_table(spark, sf_dir, "documents"), _fold("doc_id", 5, 1))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs), ["doc_id"])


#: Target weights of the mix: by rating of the document, by language; sources weigh the same.
MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS: list[dict[str, int]] = [{"rated_good": 6, "unrated": 3, "rated_poor": 1}, {"en": 4, "de": 2, "es": 2, "fr": 2}, {}]


def with_domain(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the domain that the quality label gives; without one it is unrated."""
    rated = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("rated_id")).agg(F.max("quality").alias("rating"))
    domain = F.when(F.col("rating") > 0, "rated_good").when(F.col("rating") <= 0, "rated_poor").otherwise("unrated")
    kept = [docs[c] for c in docs.columns if c != "domain"]
    return docs.join(rated, docs["doc_id"] == rated["rated_id"], "left").select(*kept, domain.alias("domain"))


def op10_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    chosen = mixing.select(_table(spark, sf_dir, "documents"), MIX_LEVELS, MIX_WEIGHTS, attach=lambda rows: with_domain(rows, labels))
    return chosen.select("doc_id", *MIX_LEVELS, "n_tokens", "epoch", "tokens_taken")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [alignment.public_file(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(_table(spark, sf_dir, "documents"), *files)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.groups(_table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(*trie.branched(trie.ordered(_table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_hash_prefix_forest": op2_hash_prefix_forest,
    "op3_language_id": op3_language_id,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_wrapper_extraction": op6_wrapper_extraction,
    "op7_revisit_resolution": op7_revisit_resolution,
    "op8_recurrent_lm_scores": op8_recurrent_lm_scores,
    "op9_personal_data": op9_personal_data,
    "op10_mix_to_weights": op10_mix_to_weights,
    "op11_token_alignment": op11_token_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_conversation_trie": op13_conversation_trie,
}

#: The others are checked against brute force, definitions and held-out rows in the tests.
ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": oracles.license_scan(),
    "op4_benchmark_decontamination": oracles.DECONTAMINATION,
    "op7_revisit_resolution": oracles.REVISITS,
    "op10_mix_to_weights": oracles.mix(MIX_LEVELS, MIX_WEIGHTS),
    "op12_exact_dedup": oracles.EXACT_DEDUP,
    "op13_conversation_trie": oracles.TRIE,
}
