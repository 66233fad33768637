"""Registered queries.  Importing this package fills ``registry.REGISTRY``."""

from . import (feature_queries, io_queries, metric_queries, model_queries, neighbor_queries,  # noqa: F401
               prepare_queries, profile_queries, stage_queries)
from .registry import REGISTRY, oracle_text, spark_callable

__all__ = ["REGISTRY", "oracle_text", "spark_callable"]
