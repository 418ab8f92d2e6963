"""Grading against the answer key. Kept apart: nothing else reads the key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.functions.money import share
from tieout.operators.summary import side_by_side

MISS_FIELDS = (
    "order_id",
    "ground_truth",
    "engine_category",
    "agent_cause",
    "agent_confidence",
    "agent_explanation",
)


def join_truth(result: DataFrame, truth: DataFrame) -> DataFrame:
    """Results that have an answer, with it. Compare counts to see whether any are lost."""
    key = truth.select("order_id", F.col("exception_type").alias("true_category"))
    return result.join(key, "order_id")


def truth_lookup(audit: DataFrame, truth: DataFrame) -> DataFrame:
    key = truth.select("order_id", F.col("exception_type").alias("ground_truth"))
    return audit.join(key, "order_id")


def confusion_matrix(graded: DataFrame, true: str, predicted: str) -> DataFrame:
    return (
        graded.groupBy(F.col(true).alias("true_label"), F.col(predicted).alias("predicted_label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("true_label", "predicted_label")
    )


def _accuracy(graded: DataFrame, right: Column, prefix: str) -> DataFrame:
    total, correct = f"{prefix}_graded_orders", f"{prefix}_correct"
    counted = graded.agg(F.count(F.lit(1)).alias(total), F.count_if(right).alias(correct))
    rate = share(F.col(correct), F.col(total)).alias(f"{prefix}_accuracy")
    return counted.select(total, correct, rate)


def engine_accuracy(graded: DataFrame) -> DataFrame:
    return _accuracy(graded, F.col("category") == F.col("true_category"), "engine")


def engine_mismatches(graded: DataFrame) -> DataFrame:
    wrong = graded.filter(F.col("category") != F.col("true_category"))
    return wrong.select("order_id", "category", "true_category", "reasoning")


def _assessed(looked_up: DataFrame) -> DataFrame:
    return looked_up.filter(F.col("agent_invoked") & (F.col("agent_cause") != ""))


def agent_confusion(looked_up: DataFrame) -> DataFrame:
    return confusion_matrix(_assessed(looked_up), "ground_truth", "agent_cause")


def agent_accuracy(looked_up: DataFrame) -> DataFrame:
    """Over orders that got an answer; no answers, no accuracy."""
    right = F.col("agent_cause") == F.col("ground_truth")
    return _accuracy(_assessed(looked_up), right, "agent")


def agent_misses(looked_up: DataFrame) -> DataFrame:
    wrong = _assessed(looked_up).filter(F.col("agent_cause") != F.col("ground_truth"))
    return wrong.select(*MISS_FIELDS)


def grading_counts(looked_up: DataFrame) -> DataFrame:
    """Both gradings on one row, from one pass; an empty grading has engine accuracy 0."""
    assessed = F.col("agent_invoked") & (F.coalesce("agent_cause", F.lit("")) != "")
    engine_right = F.col("engine_category") == F.col("ground_truth")
    agent_right = assessed & (F.col("agent_cause") == F.col("ground_truth"))
    counted = looked_up.agg(
        F.min("run_id").alias("run_id"),
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(engine_right).alias("engine_correct"),
        F.count_if(assessed).alias("agent_graded_orders"),
        F.count_if(agent_right).alias("agent_correct"),
    )
    engine_rate = share(F.col("engine_correct"), F.col("total_orders"))
    return counted.select(
        "run_id",
        "total_orders",
        "engine_correct",
        F.coalesce(engine_rate, F.lit(0.0)).alias("engine_accuracy"),
        "agent_graded_orders",
        "agent_correct",
        share(F.col("agent_correct"), F.col("agent_graded_orders")).alias("agent_accuracy"),
    )


def confusion_map(pairs: DataFrame) -> DataFrame:
    """A confusion matrix as one nested map. ``pairs`` has one row per pair of codes."""
    inner = pairs.groupBy("true_label").agg(
        F.map_from_entries(F.collect_list(F.struct("predicted_label", "n"))).alias("_row")
    )
    return inner.agg(F.map_from_entries(F.collect_list(F.struct("true_label", "_row"))).alias("m"))


def grading_report(looked_up: DataFrame, graded_at: str | None = None) -> DataFrame:
    """The grading document. Misses are rows of their own (:func:`agent_misses`)."""
    at = F.coalesce(
        F.lit(graded_at).cast("timestamp"), F.date_trunc("second", F.current_timestamp())
    )
    engine = confusion_map(confusion_matrix(looked_up, "ground_truth", "engine_category"))
    agent = confusion_map(agent_confusion(looked_up))
    counted = grading_counts(looked_up).withColumn("graded_at", at)
    return side_by_side(
        counted,
        engine.withColumnRenamed("m", "engine_confusion"),
        agent.withColumnRenamed("m", "agent_confusion"),
    )
