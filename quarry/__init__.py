"""quarry — reusable analytic operators and a catalogue of named queries on Spark.

Operators take DataFrames and column names and return DataFrames; they are
built from Spark SQL / DataFrame / MLlib primitives only, so all work runs on
executors. ``quarry.catalog`` exposes named, parameterised queries
(``run_query`` / ``list_query_names``).
"""

from quarry.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
