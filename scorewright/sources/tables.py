"""Readers: driver parquet tables, typed CSV, labelled-table dispatch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Parquet: Catalyst pushes filters and prunes columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Schema of the reference entity table (header of its test CSV), fixed values.
ENTITY_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in (
        "age_first_funding_year", "age_last_funding_year",
        "age_first_milestone_year", "age_last_milestone_year")]
    + [T.StructField("relationships", T.IntegerType()),
       T.StructField("funding_rounds", T.IntegerType()),
       T.StructField("funding_total_usd", T.LongType()),
       T.StructField("milestones", T.IntegerType())]
    + [T.StructField(c, T.IntegerType()) for c in (
        "is_CA", "is_NY", "is_MA", "is_TX", "is_otherstate")]
    + [T.StructField("category_code", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in (
        "is_software", "is_web", "is_mobile", "is_enterprise", "is_advertising",
        "is_gamesvideo", "is_ecommerce", "is_biotech", "is_consulting", "is_othercategory")]
    + [T.StructField(c, T.IntegerType()) for c in (
        "has_VC", "has_angel", "has_roundA", "has_roundB", "has_roundC", "has_roundD")]
    + [T.StructField("avg_participants", T.DoubleType())]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             with_label: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data).

    ``with_label`` appends an int label column to the schema (training file).
    """
    schema = schema or ENTITY_SCHEMA
    if with_label and with_label not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(with_label, T.IntegerType())])
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_csv_or_none(spark: SparkSession, path: str, **kw) -> DataFrame | None:
    """S3: missing-file guard; ``None`` when the path does not exist."""
    try:
        df = read_csv(spark, path, **kw)
        df.schema  # resolves the path
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def require_columns(df: DataFrame, names) -> DataFrame:
    """``df`` if it has all the columns; else an error that lists the missing ones."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df


def load_labeled(spark: SparkSession, source, target: str | None) -> DataFrame:
    """A path or a DataFrame, with a named target column that must exist."""
    if target is None:
        raise ValueError("target column must be given")
    df = read_csv(spark, source, with_label=target) if isinstance(source, str) else source
    return require_columns(df, [target])
