"""scorecraft: Spark-native data profiling, cleaning, encoding and scorecard modelling.

Every operator is a DataFrame -> DataFrame transform, a distributed aggregation
or a Spark ML job.  Results are long-form DataFrames; only parameters whose size
is bounded by the number of columns or model terms ever reach the driver.
"""

from scorecraft.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
