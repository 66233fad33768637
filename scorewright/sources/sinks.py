"""Sinks: prediction files, template-ordered files, probability files, models.

Outputs go to a folder the caller names (on a cluster: shared storage).  Writes
are whole-folder overwrites, so a retried job leaves no partial output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.persist import load, save


def predictions_frame(df: DataFrame, key: str = "id", pred: str = "prediction") -> DataFrame:
    """S5 payload: ``{id, labels}``."""
    return df.select(F.col(key).alias("id"), F.col(pred).cast("int").alias("labels"))


def fill_template(template: DataFrame, preds: DataFrame, key: str = "id") -> DataFrame:
    """Attach predictions to the template's ids by key (not by position)."""
    return template.select(key).join(preds, key, "left")


def probabilities_frame(df: DataFrame, key: str = "id", prob: str = "p1", pred: str = "prediction") -> DataFrame:
    """S8 payload: ``{id, probability, prediction}`` with the real key kept."""
    return df.select(F.col(key).alias("id"), F.col(prob).alias("probability"),
                     F.col(pred).cast("int").alias("prediction"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """Spark ML persistence instead of pickle, for pipelines, this library's models and the facade."""
    save(model, path)


def load_model(path: str):
    """The saved model, of whatever class."""
    return load(path)
