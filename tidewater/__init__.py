"""tidewater — Spark-native operators for layered (bronze/silver/gold) analytics tables.

Every operator takes and returns a Spark DataFrame (or a Column) and is built only from
built-in Spark SQL functions, so plans stay inside Catalyst and whole-stage codegen.
"""

from tidewater.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
