"""Term weights and feature vectors of sessions (or any documents).

Counts are taken per document and term with partial aggregation, so a session of any
length is reduced before it is shuffled and never held as one array.
"""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import IDF, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog.functions.vectors import map_sparse, sparse_vector


def term_counts(events: DataFrame, document="block_id", term="event_id") -> DataFrame:
    return events.groupBy(document, term).agg(F.count("*").alias("tf"))


def hashed_counts(events: DataFrame, document="block_id", term="event_id",
                  width=K.FEATURE_WIDTH) -> DataFrame:
    """Counts per hash bucket. For ids of 8 characters this is the bucket that MLlib's
    HashingTF gives; other lengths may fall into other buckets."""
    bucket = F.pmod(F.hash(term), F.lit(width)).alias("bucket")
    return events.groupBy(document, bucket).agg(F.count("*").cast("double").alias("tf"))


def count_vectors(events: DataFrame, document="block_id", term="event_id",
                  width=K.FEATURE_WIDTH, time=None) -> DataFrame:
    """One sparse term-frequency vector per document, of at most width entries. With time, also
    first_time and n_events, from the same aggregation."""
    bucket = F.pmod(F.hash(term), F.lit(width)).alias("bucket")
    first = [] if time is None else [F.min(time).alias("first_time")]
    per_bucket = events.groupBy(document, bucket).agg(F.count("*").cast("double").alias("tf"), *first)
    heads = [] if time is None else [
        F.min("first_time").alias("first_time"), F.sum("tf").cast("bigint").alias("n_events")]
    per_document = per_bucket.groupBy(document).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "tf"))).alias("_terms"), *heads)
    counts = sparse_vector(width, F.col("_terms.bucket"), F.col("_terms.tf")).alias("counts")
    return per_document.select(document, *(["first_time", "n_events"] if heads else []), counts)


def idf_weights(counts: DataFrame, n_documents: int, term="event_id", min_count=1) -> DataFrame:
    """ln((m + 1) / (df + 1)); terms in fewer than min_count documents weigh 0. total: how often
    the term occurs in all."""
    df = counts.groupBy(term).agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    idf = F.log((F.lit(n_documents) + 1) / (F.col("df") + 1))
    return df.withColumn("idf", F.when(F.col("df") >= min_count, idf).otherwise(F.lit(0.0)))


def tfidf(counts: DataFrame, weights: DataFrame, term="event_id") -> DataFrame:
    return counts.join(weights.select(term, "idf"), term).withColumn(
        "tfidf", F.col("tf") * F.col("idf")
    )


def term_means(weights: DataFrame, n_documents: int, term="event_id") -> DataFrame:
    """The mean tfidf of each term of idf_weights over all documents, without a look at the entries."""
    return weights.select(term, (F.col("idf") * F.col("total") / F.lit(float(n_documents))).alias("_mean"))


def centred(weighted: DataFrame, n_documents: int, term="event_id", value="tfidf", means=None) -> DataFrame:
    """Entries minus the term's mean over all documents. A document without the term has
    the value baseline = -mean, so the dense matrix need not be written out. means: those of
    term_means, where value is the tfidf; else they are summed up from the entries."""
    if means is None:
        means = weighted.groupBy(term).agg(
            (F.sum(value) / F.lit(float(n_documents))).alias("_mean")
        )
    return weighted.join(means, term).select(
        *weighted.columns,
        (F.col(value) - F.col("_mean")).alias("centred"),
        (-F.col("_mean")).alias("baseline"),
    )


def ratio(value):
    """v / (1 + v)."""
    return value / (F.lit(1.0) + value)


class RatioNormalizer(Transformer, HasInputCol, HasOutputCol,
                      DefaultParamsReadable, DefaultParamsWritable):
    """v / (1 + v) on the stored entries of a sparse vector; zero stays zero."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        return dataset.withColumn(
            self.getOutputCol(), map_sparse(F.col(self.getInputCol()), ratio)
        )


class ImplicitCentre(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Centring without dense vectors: learns the mean, and hands sparse vectors on as they are.
    A linear model with an intercept fitted on them is that of the centred vectors but for its
    intercept, into which centred_model folds the mean."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        mean = dataset.agg(Summarizer.mean(F.col(self.getInputCol()))).first()[0]
        model = ImplicitCentreModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol())
        if mean is None:
            return model
        held = mean.toArray()
        return model._set(size=len(held), mean={str(i): float(held[i]) for i in held.nonzero()[0]})


class ImplicitCentreModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    size = Param(Params._dummy(), "size", "width of the vectors", TypeConverters.toInt)
    mean = Param(Params._dummy(), "mean", "mean of each place that is not zero")

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._setDefault(size=0, mean={})
        self._set(**self._input_kwargs)

    def means(self):
        """The mean vector."""
        return Vectors.sparse(self.getOrDefault(self.size), {int(i): m for i, m in self.getOrDefault(self.mean).items()})

    def _transform(self, dataset):
        return dataset.withColumn(self.getOutputCol(), F.col(self.getInputCol()))


def centred_model(centre: ImplicitCentreModel, linear) -> tuple:
    """(coefficients, intercept) that a fitted linear model has over centred vectors."""
    return linear.coefficients, float(linear.intercept + linear.coefficients.dot(centre.means()))


def feature_stages(term_weighting="tf-idf", normalization=None, min_count=1,
                   input_col="counts", output_col="assembled_features"):
    """Pipeline stages from count vectors to the model's input.

    normalization: None, "zero-mean", or "ratio" (also called "sigmoid"). Centring is implicit:
    an unregularised linear model fitted on the sparse vectors gives the same predictions, as the
    means only move its intercept.
    """
    stages, column = [], input_col
    if term_weighting == "tf-idf":
        stages.append(IDF(inputCol=column, outputCol="tfidf_features", minDocFreq=min_count))
        column = "tfidf_features"
    elif term_weighting is not None:
        raise ValueError("term_weighting must be 'tf-idf' or None")
    if normalization == "zero-mean":
        stages.append(ImplicitCentre(inputCol=column, outputCol="features"))
    elif normalization in ("ratio", "sigmoid"):
        stages.append(RatioNormalizer(inputCol=column, outputCol="features"))
    elif normalization is not None:
        raise ValueError("normalization must be None, 'zero-mean', 'ratio' or 'sigmoid'")
    if normalization is not None:
        column = "features"
    stages.append(VectorAssembler(inputCols=[column], outputCol=output_col))
    return stages
