"""The pipeline's stages, and the queries that have no SQL twin, on small tables."""

from pyspark.sql import functions as F

import corpus_pipeline
from cinderlog.llm import minhash, spaced_seeds
from cinderlog.llm.queries import QUERIES


def test_every_query_answers_for_every_row(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for number in (1, 2, 4, 5, 7, 8, 10):
        (query,) = [f for name, f in QUERIES.items() if name.startswith(f"op{number}_")]
        assert query(spark, sf_dir).count() == n


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, sf_dir)
        assert kept.columns == docs.columns
        assert kept.select("doc_id").exceptAll(before.select("doc_id")).isEmpty(), name
        if name == "near_duplicates":
            wanted = minhash.near_duplicates(before).where("kept").select("doc_id")
            assert sorted(wanted.collect()) == sorted(kept.select("doc_id").collect())
        if name == "decontamination":
            assert spaced_seeds.overlaps(kept, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).isEmpty()
        if name == "personal_data":
            assert kept.count() == before.count()
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.where(F.size("ids") != F.col("n_tokens")).isEmpty()
    assert sorted(result.select("doc_id").collect()) == sorted(kept.select("doc_id").collect())


def test_rows_are_told_apart_by_id_and_text(spark, sf_dir):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (5, "apple pie with cream on top"), (5, "zebra in the zoo at night"),
            (None, "q"), (None, "q"), (None, long), (9, long + " more"), (2, ""), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, sf_dir).collect()
    want = [(1, "a b c d e f g"), (5, rows[2][1]), (5, rows[3][1]), (None, "q"), (9, long + " more"), (2, ""), (3, None)]
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, want))


def test_decontamination_judges_each_text(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(None, "before " + item), (4, item + " after"), (4, "a clean text"), (6, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.without_benchmark(spark, docs, sf_dir).collect()
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, rows[2:]))


CLASHING = ["score", "terms", "ids", "m_email", "pii", "seed", "digest", "node", "neighbours", "position", "_given"]


def test_stages_take_any_column_names_and_empty_tables(spark, sf_dir):
    rows = [(i, f"mail me at me{i}@mail.org " + "word " * i, "s", "en", i) for i in range(1, 9)] + [(None, None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    docs = docs.withColumns({c: F.lit(c) for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        last = name == "encoding"
        assert out.columns == [c for c in docs.columns if not last or c != "ids"] + ["ids", "n_tokens"] * last
        held = [c for c in CLASHING if not last or c != "ids"]
        assert all(r[c] == c for r in out.collect() for c in held), name
        assert stage(spark, docs.limit(0), sf_dir).isEmpty(), name
