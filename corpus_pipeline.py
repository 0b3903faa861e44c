"""Corpus pipeline: toxic documents out, near-duplicates out, benchmark passages out, personal
data masked, texts encoded. Each stage takes (spark, docs, sf_dir) and works on all that its
predecessor kept; all but the last return the columns of documents."""

from pyspark.sql import functions as F

from cinderlog.llm import minhash, pii, spaced_seeds, suffix_pieces, toxicity
from cinderlog.llm.common import fold, set_apart, table
from cinderlog.llm.queries import TOXIC_FROM
from cinderlog.operators.ranking import positions
from cinderlog.session import write_table


def without_toxic(spark, docs, sf_dir):
    """Learns from the labelled documents of the table (but for the held-out ones, as the query
    does), and drops the given documents that score as toxic. Null and empty texts score as texts
    without any term do; repeated rows are judged alike; texts are read whole; columns may have any
    names."""
    learn = table(spark, sf_dir, "documents").where(~fold(F.col("doc_id"), 4, 2))
    index = toxicity.train(spark, learn, table(spark, sf_dir, "labels"))
    inner, restore = set_apart(docs)
    return restore(toxicity.score(inner, index, inner.columns).where(F.col("score") < TOXIC_FROM))


def _numbered(docs):
    """(rows, numbers): rows with the digest of their text, and number, doc_id, digest for each
    distinct pair of them, numbered in order of doc_id (null last) and digest."""
    rows = docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    pairs = write_table(rows.select(F.col("doc_id").isNull().alias("late"), "doc_id", "digest").distinct(), "pairs")
    return rows, write_table(positions(pairs, ["late", "doc_id", "digest"], rows=pairs.count()), "numbers")


def without_near_duplicates(spark, docs, sf_dir):
    """Keeps of each group of documents linked by their 5-word shingles at a similarity of 0.8 or
    more the one with the smallest doc_id (null last; ties by digest of the text). Rows are told
    apart by doc_id and text: of equal ones a single row stays, and different texts are separate
    documents even with the same or no doc_id. Null and empty texts are linked with nothing.
    Columns may have any names."""
    inner, restore = set_apart(docs)
    ids = inner.agg(F.count("*"), F.count("doc_id"), F.countDistinct("doc_id")).first()
    if len(set(ids)) == 1:
        dropped = write_table(minhash.near_duplicates(inner).where(~F.col("kept")).select("doc_id"), "dropped")
        return restore(inner.join(dropped, "doc_id", "left_anti"))
    rows, numbers = _numbered(inner)
    same = rows["doc_id"].eqNullSafe(numbers["doc_id"]) & (rows["digest"] == numbers["digest"])
    numbered = rows.join(numbers, same).select(
        *[rows[c] for c in inner.columns if c != "doc_id"], rows["doc_id"], numbers["position"])
    columns = [c for c in inner.columns]
    single = numbered.groupBy("position").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row"))
    single = write_table(single, "single")
    groups = minhash.near_duplicates(single.select(F.col("position").alias("doc_id"), "row.text"))
    dropped = write_table(groups.where(~F.col("kept")).select(F.col("doc_id").alias("position")), "dropped")
    return restore(single.join(dropped, "position", "left_anti").select("row.*"))


def without_benchmark(spark, docs, sf_dir):
    """Drops documents that overlap with a benchmark item, each by its own text. Null and empty
    texts stay; columns may have any names."""
    inner, restore = set_apart(docs)
    return restore(spaced_seeds.clean(inner, table(spark, sf_dir, "benchmark")))


def without_personal_data(spark, docs, sf_dir):
    """Masks personal data in the texts; n_chars follows. All rows stay, null and empty texts as
    they are; columns may have any names."""
    inner, restore = set_apart(docs, ("doc_id", "text", "n_chars"))
    return restore(pii.redact(inner))


def encoded(spark, docs, sf_dir):
    """The documents with their SentencePiece ids and their number; columns of the documents
    with these two names are left out. Null and empty texts have no ids."""
    inner, restore = set_apart(docs)
    found = suffix_pieces.encode(inner, suffix_pieces.load(), inner.columns)
    return restore(found.withColumn("n_tokens", F.size("ids").cast("long")), "ids", "n_tokens")


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("encoding", encoded),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # learned scores, minima of hashes and piece merging are beyond SQL
