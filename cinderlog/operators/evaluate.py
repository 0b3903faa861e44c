"""Evaluation of a binary classifier."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog.functions.ratios import classification_metrics
from cinderlog.operators.ranking import running_total


def confusion(predictions: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """True/false positives/negatives and the ratios made of them, in one aggregate."""
    positive, flagged = F.col(label) == 1, F.col(prediction) == 1
    cells = predictions.agg(
        F.count_if(positive & flagged).alias("tp"),
        F.count_if((F.col(label) == 0) & flagged).alias("fp"),
        F.count_if((F.col(label) == 0) & (F.col(prediction) == 0)).alias("tn"),
        F.count_if(positive & (F.col(prediction) == 0)).alias("fn"),
    )
    return cells.withColumns(classification_metrics(*[F.col(c) for c in ("tp", "fp", "tn", "fn")]))


def roc_auc(scored: DataFrame, score="score", label="label") -> DataFrame:
    """Area under the ROC curve: the share of positive-negative pairs in which the
    positive scores higher, ties counting half. Rows are first counted per distinct
    score; the running count of negatives is taken piece by piece."""
    per_score = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )
    ranked = running_total(per_score, ["score"], {"neg_so_far": F.col("neg")})
    wins = F.col("pos") * (F.col("neg_so_far") - F.col("neg") / 2)
    sums = ranked.agg(F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(
        F.try_divide(F.col("wins"), F.col("p").cast("double") * F.col("n")).alias("roc_auc")
    )
