"""scorewright: Spark-native tabular scoring and binary classification.

Layout
------
sources/    readers, fixture views over the driver tables, sinks
functions/  null-exact column helpers, schema helpers, exact quantiles, ranks
operators/  feature derivation, profiling, preparation, splitting, metrics, models
plans/      the registered queries and their DuckDB oracle twins
streaming/  Structured Streaming scoring
"""

__version__ = "0.1.0"
