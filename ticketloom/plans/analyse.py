"""Status over models and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import dates
from ticketloom.operators import governance
from ticketloom.operators.scans import as_time


def engine_status(cycles: DataFrame, predictions: DataFrame) -> DataFrame:
    """Current model and last scoring run of every center, also of one that was never scored."""
    models = governance.latest_per_center(cycles).select("tech_center", "model_version", "silhouette_score")
    marks = predictions.groupBy("tech_center").agg(
        F.max("prediction_timestamp").alias("last_prediction"), F.count("*").alias("n_predictions")
    )
    return models.join(marks, "tech_center", "left").fillna(0, ["n_predictions"])


def pipeline_status(
    cycles: DataFrame, predictions: DataFrame, centers: DataFrame, as_of, training_months: int = dates.TRAINING_WINDOW_MONTHS,
    cadence_months: int = 6, prediction_minutes: int = 120,
) -> DataFrame:
    """One row for the whole engine: cadences and window as set, centers, current models, and what ran last and comes next."""
    now = as_time(as_of)
    models = governance.latest_per_center(cycles).agg(
        F.count("*").alias("current_models"), F.max("training_completed_date").alias("last_training")
    )
    scored = predictions.agg(F.count("*").alias("predictions"), F.max("prediction_timestamp").alias("last_prediction"))
    known = centers.agg(F.count_distinct("tech_center").alias("tech_centers_count"))
    one = F.lit(1).alias("_one")
    joined = models.withColumn("_one", one).join(scored.withColumn("_one", one), "_one").join(known.withColumn("_one", one), "_one")
    return joined.select(
        F.lit(cadence_months).alias("training_frequency_months"), F.lit(training_months).alias("training_window_months"),
        F.lit(prediction_minutes).alias("prediction_frequency_minutes"), "tech_centers_count", "current_models", "last_training",
        F.add_months("last_training", cadence_months).cast("timestamp").alias("next_training"), "predictions", "last_prediction", now.alias("last_updated"),
    )
