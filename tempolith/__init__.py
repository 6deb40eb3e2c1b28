"""tempolith: Spark-native analytics for entities observed through time.

Every public function takes and returns a lazy ``pyspark.sql.DataFrame`` built
only from native Spark expressions; nothing is collected to the driver except
bounded fitted parameters (scaler moments, category lists, calibration scales).
"""

from tempolith.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
