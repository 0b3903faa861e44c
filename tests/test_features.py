import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cinderlog.checks import queries
from cinderlog.functions.ratios import throughput
from cinderlog.operators import evaluate, features
from cinderlog.operators.sessions import session_parts
from cinderlog.plans import anomaly
from cinderlog.session import scratch_path


def test_vectors_equal_hashing_tf(skewed_events):
    """Counts of a heavy session equal those of its whole event array."""
    ours = features.count_vectors(skewed_events)
    whole = session_parts(skewed_events).select("block_id", "event_sequence")
    theirs = HashingTF(inputCol="event_sequence", outputCol="v", numFeatures=65536).transform(whole)
    both = ours.join(theirs, "block_id")
    assert both.count() == whole.count()
    assert both.where(F.col("counts") != F.col("v")).count() == 0


def test_idf_equals_mllib(skewed_events):
    vectors = features.count_vectors(skewed_events)
    model = IDF(inputCol="counts", outputCol="w").fit(vectors)
    dense = model.idf.toArray()
    hashed = features.hashed_counts(skewed_events)
    ours = features.idf_weights(hashed, vectors.count(), "bucket").collect()
    assert ours and all(math.isclose(r.idf, dense[r.bucket], abs_tol=1e-12) for r in ours)
    rare = features.idf_weights(hashed, vectors.count(), "bucket", min_count=10 ** 6)
    assert rare.where("idf <> 0").count() == 0


def test_centred_twin_equals_dense(spark):
    counts = spark.createDataFrame(
        [("a", "x", 2), ("a", "y", 1), ("b", "x", 1), ("c", "z", 4)], "block_id string, event_id string, tf bigint"
    )
    weighted = features.tfidf(counts, features.idf_weights(counts, 4))  # one document is empty
    got = {(r.block_id, r.event_id): r for r in features.centred(weighted, 4).collect()}
    dense = {t: {d: 0.0 for d in "abcd"} for t in "xyz"}
    for (d, t), r in got.items():
        dense[t][d] = r.tfidf
    for t, column in dense.items():
        mean = sum(column.values()) / 4
        for d, value in column.items():
            if (d, t) in got:
                assert math.isclose(got[d, t].centred, value - mean) and math.isclose(got[d, t].baseline, -mean)


def test_means_from_weights_equal_those_of_entries(spark):
    counts = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "x", 1)], "block_id string, event_id string, tf bigint")
    weights = features.idf_weights(counts, 3)
    weighted = features.tfidf(counts, weights)
    key = lambda r: (r.block_id, r.event_id)
    summed, given = (sorted(features.centred(weighted, 3, means=m).collect(), key=key) for m in (None, features.term_means(weights, 3)))
    assert len(given) == 3 and [key(r) for r in given] == [key(r) for r in summed]
    assert all(math.isclose(a.centred, b.centred) and math.isclose(a.baseline, b.baseline) for a, b in zip(summed, given))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_word_counts_shuffle_texts_only(spark, sf_dir):
    counts = plan_of(queries.term_frequency(spark, sf_dir))
    assert counts.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in counts
    centred = plan_of(queries.tfidf_centered(spark, sf_dir))
    assert centred.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in centred


def test_ratio_stage_saves_and_loads(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.sparse(5, [1, 3], [1.0, 3.0]),), (Vectors.sparse(5, [], []),)], ["counts"])
    model = Pipeline(stages=features.feature_stages(None, "sigmoid")).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df)
    assert [list(r.assembled_features.toArray()) for r in again.collect()] == [[0, 0.5, 0, 0.75, 0], [0] * 5]
    parts = again.select(features.ratio(F.lit(3.0))).first()
    assert parts[0] == 0.75


@pytest.mark.parametrize("bad", [dict(term_weighting="x"), dict(normalization="x")])
def test_stage_arguments(bad):
    with pytest.raises(ValueError):
        features.feature_stages(**bad)


@pytest.fixture(scope="module")
def sessions(spark):
    rows = []
    for i in range(60):
        label = int(i % 4 == 0)
        terms = {3: 1.0 + i % 3, 7: float(i % 5 + 1), 11: 2.0 * label + i % 2}
        keep = {k: v for k, v in terms.items() if v}
        rows.append((f"blk_{i}", label, Vectors.sparse(16, sorted(keep), [keep[k] for k in sorted(keep)])))
    return spark.createDataFrame(rows, ["block_id", "label", "counts"]).withColumn("label", F.col("label").cast("int"))


def test_centring_does_not_change_predictions(sessions):
    plain = anomaly.predict(anomaly.fit(sessions, "tf-idf"), sessions)
    centred = anomaly.predict(anomaly.fit(sessions, "tf-idf", "zero-mean"), sessions)
    a = {r.block_id: r.prediction for r in plain.collect()}
    assert a == {r.block_id: r.prediction for r in centred.collect()} and 0 < sum(a.values()) < 60


def test_implicit_centring_equals_dense(spark, sessions):
    """Same margins as a model of dense centred vectors, without a dense vector."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import vector_to_array

    noisy = sessions.withColumn("label", F.when(F.xxhash64("block_id") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    model = anomaly.fit(noisy, "tf-idf", "zero-mean")
    path = scratch_path(spark, "centred")
    model.write().overwrite().save(path)
    model = PipelineModel.load(path)
    _, centre, _, linear = model.stages
    out = model.transform(noisy)
    assert all("SparseVector" in type(r[0]).__name__ for r in out.select("features").collect())
    counts = noisy.select(F.expr("*"))
    dense = Pipeline(stages=[
        IDF(inputCol="counts", outputCol="t"),
        StandardScaler(inputCol="t", outputCol="d", withMean=True, withStd=False),
        LogisticRegression(featuresCol="d", labelCol="label")]).fit(counts)
    theirs = {r[0]: r[1] for r in dense.transform(noisy).select("block_id", vector_to_array("rawPrediction")[1]).collect()}
    ours = {r.block_id: r.raw_margin for r in anomaly.predict(model, noisy).collect()}
    assert all(math.isclose(ours[b], theirs[b], abs_tol=1e-3) for b in theirs)
    weights, intercept = features.centred_model(centre, linear)
    means = centre.means().toArray()
    for r in out.select("block_id", "features").collect():
        assert math.isclose(float((r.features.toArray() - means) @ weights.toArray() + intercept), ours[r.block_id], abs_tol=1e-9)


def test_vectors_with_heads_in_one_aggregation(skewed_events):
    from cinderlog.operators.sessions import session_heads
    both = features.count_vectors(skewed_events, time="event_time")
    plain = features.count_vectors(skewed_events).join(session_heads(skewed_events), "block_id")
    columns = ["block_id", "first_time", "n_events", "counts"]
    assert sorted(map(repr, both.select(columns).collect())) == sorted(map(repr, plain.select(columns).collect()))
    assert "Join" not in both._jdf.queryExecution().executedPlan().toString()


def test_model_round_trip(spark, sessions):
    model = anomaly.fit(sessions, normalization="ratio")
    path = scratch_path(spark, "roundtrip")
    model.write().overwrite().save(path)
    before = sorted(map(tuple, anomaly.predict(model, sessions).collect()))
    assert sorted(map(tuple, anomaly.predict(PipelineModel.load(path), sessions).collect())) == before


def test_train_and_score_flow(spark, store):
    blocks = store.select(F.explode(F.expr("regexp_extract_all(content, '(blk_-?[0-9]+)', 1)")).alias("BlockId"))
    labels = blocks.distinct().withColumn(
        "Label", F.when(F.xxhash64("BlockId") % 4 == 0, "Anomaly").otherwise("Normal")
    )
    path = scratch_path(spark, "flow")
    model, metrics = anomaly.train(store, labels, path, split_type="uniform", ratio=0.7)
    m = metrics.first()
    assert m.tp + m.fp + m.tn + m.fn > 0 and 0 <= m.roc_auc <= 1 and 0 <= m.accuracy <= 1
    scored = anomaly.score(spark, store, path)
    total = anomaly.summary(scored).first()
    assert total.block_ids_count == blocks.distinct().count()
    assert total.anomaly_count == anomaly.anomalous(scored).count()


def test_auc_equals_evaluator(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(40))).cast("double").alias("score"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int").alias("label"),
    )
    want = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(df)
    assert math.isclose(evaluate.roc_auc(df).first()[0], want, abs_tol=1e-12)
    assert evaluate.roc_auc(df.where("label = 1")).first()[0] is None


def test_confusion_of_one_class(spark):
    df = spark.createDataFrame([(0, 0)] * 3, "label int, prediction int")
    assert tuple(evaluate.confusion(df).first()) == (0, 0, 3, 0, 1.0, 0.0, 0.0, 0.0)
    empty = evaluate.confusion(df.limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)


def test_throughput_guard(spark):
    row = spark.range(1).select(throughput(F.lit(4.0), F.lit(2.0)), throughput(F.lit(4.0), F.lit(0.0))).first()
    assert tuple(row) == (2.0, 0.0)
