"""Train and apply the block anomaly classifier."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog.operators.evaluate import confusion, roc_auc
from cinderlog.operators.features import count_vectors, feature_stages
from cinderlog.operators.sessions import block_events, session_parts, session_slices, with_labels
from cinderlog.operators.splits import split_sessions
from cinderlog.session import write_table
from cinderlog.sources.sinks import write_csv


def session_vectors(structured: DataFrame, labels=None, width=K.FEATURE_WIDTH) -> DataFrame:
    """One row per block: block_id, first_time, n_events, counts[, label], stored."""
    sessions = count_vectors(block_events(structured), width=width, time="event_time")
    if labels is not None:
        sessions = with_labels(sessions, labels)
    return write_table(sessions, "sessions")


def fit(train: DataFrame, term_weighting="tf-idf", normalization=None, min_count=1) -> PipelineModel:
    stages = feature_stages(term_weighting, normalization, min_count)
    stages.append(LogisticRegression(featuresCol="assembled_features", labelCol="label"))
    return Pipeline(stages=stages).fit(train)


def predict(model: PipelineModel, sessions: DataFrame) -> DataFrame:
    """block_id, raw_margin, prediction and any label."""
    out = model.transform(sessions)
    keep = [c for c in ("label",) if c in out.columns]
    return out.select(
        "block_id", *keep,
        vector_to_array("rawPrediction")[1].alias("raw_margin"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: confusion cells, accuracy, precision, recall, F1 and ROC AUC."""
    area = roc_auc(predictions, "raw_margin").first()[0]
    return confusion(predictions).withColumn("roc_auc", F.lit(area).cast("double"))


def train(structured: DataFrame, labels: DataFrame, model_path, ratio=0.8,
          split_type="sequential", export_path=None, slice_width=None, **options):
    """Sessions -> split -> fit -> evaluate on the test part -> save. Returns (model,
    metrics). Both parts are exported if a path is given: as slices if slice_width is."""
    sessions = session_vectors(structured, labels)
    train_part, test_part = split_sessions(sessions, ratio, split_type)
    if export_path is not None:
        export(structured, train_part, f"{export_path}/train_data", slice_width)
        export(structured, test_part, f"{export_path}/test_data", slice_width)
    model = fit(train_part, **options)
    metrics = write_table(evaluate(write_table(predict(model, test_part), "predictions")), "metrics")
    model.write().overwrite().save(model_path)
    return model, metrics


def export(structured: DataFrame, sessions: DataFrame, path, slice_width=None):
    """The chosen sessions, or their slices, with event sequences and label as CSV; heavy
    blocks in parts. Only events of these sessions are ordered."""
    keys = sessions.select("block_id", "label")
    events = block_events(structured)
    if slice_width:
        return write_csv(session_slices(events, keys, slice_width), path)
    own = events.join(keys.select("block_id"), "block_id", "left_semi")
    write_csv(session_parts(own).drop("own_events").join(keys, "block_id"), path)


def score(spark: SparkSession, structured: DataFrame, model_path) -> DataFrame:
    """Predictions of a saved model for every block."""
    return predict(PipelineModel.load(model_path), session_vectors(structured))


def anomalous(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("prediction") == 1).select("block_id", "prediction")


def summary(predictions: DataFrame) -> DataFrame:
    """One row: anomalous blocks and all blocks."""
    return predictions.agg(
        F.count_if(F.col("prediction") == 1).alias("anomaly_count"),
        F.count("*").alias("block_ids_count"),
    )
