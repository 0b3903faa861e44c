"""The operators as queries over whole tables, with production parameters, and SQL twins."""

from pyspark.sql import functions as F

from cinderlog.llm import (
    hard_negatives, isolation, kneser_ney, languages, licences, merkle, minhash, multi_index, pii,
    quotations, spaced_seeds, suffix_pieces, toxicity,
)
from cinderlog.llm.common import fold, table
from cinderlog.llm.oracle import ORACLE  # noqa: F401

TOXIC_FROM = 0.3


def op1_kneser_ney(spark, sf_dir):
    held = fold(F.col("doc_id"), 7, 2)
    documents = table(spark, sf_dir, "documents")
    model = kneser_ney.train(spark, documents.where(~held), order=3)
    return kneser_ney.score(
        documents.select("doc_id", "text", held.alias("held_out")), model, ("doc_id", "held_out")
    ).withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))


def op2_toxicity(spark, sf_dir):
    held = fold(F.col("doc_id"), 4, 2)
    documents = table(spark, sf_dir, "documents")
    index = toxicity.train(spark, documents.where(~held), table(spark, sf_dir, "labels"))
    return toxicity.score(
        documents.select("doc_id", "text", held.alias("held_out")), index, ("doc_id", "held_out")
    ).withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op3_quotations(spark, sf_dir):
    return quotations.thread(table(spark, sf_dir, "conversations"))


def op4_languages(spark, sf_dir):
    held = fold(F.col("doc_id"), 4, 2)
    documents = table(spark, sf_dir, "documents")
    profiles = languages.train(spark, documents.where(~held))
    return languages.predict(
        documents.select("doc_id", "text", held.alias("held_out")), profiles, ("doc_id", "held_out"))


def op5_licences(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return licences.scan(documents, licences.train(documents))


def op6_spaced_seeds(spark, sf_dir):
    return spaced_seeds.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op8_personal_data(spark, sf_dir):
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"] != "iban")
    return found.select(
        "doc_id", *[pii.count(F.col("pii"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


def op9_multi_index(spark, sf_dir):
    return multi_index.nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_suffix_pieces(spark, sf_dir):
    return suffix_pieces.summary(table(spark, sf_dir, "documents"), suffix_pieces.load())


def op11_isolation_forest(spark, sf_dir):
    return isolation.judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.chosen_for_tampering())


QUERIES = {f.__name__: f for f in (
    op1_kneser_ney, op2_toxicity, op3_quotations, op4_languages, op5_licences, op6_spaced_seeds,
    op7_minhash, op8_personal_data, op9_multi_index, op10_suffix_pieces,
    op11_isolation_forest, op12_hard_negatives, op13_merkle_manifest,
)}
