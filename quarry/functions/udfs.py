"""SQL-callable functions.

* ``hm_inv`` / ``hm_finish``: SQL functions (inlined by the analyzer, so they
  stay JVM-side and keep partial aggregation) that spell the harmonic mean
  in plain SQL as ``hm_finish(count(v), sum(hm_inv(v)))``.
* ``log_magnitude``: a scalar function as an SQL function, the form to choose
  where built-in functions can say it.
* ``log_magnitude_udf``: the same as a vectorized (Arrow-batched) scalar pandas
  UDF, the example for what they cannot say.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf

from quarry.functions import harmonic


def _log_magnitude(v: pd.Series) -> pd.Series:
    """log10(1 + v), one Arrow batch at a time."""
    return np.log10(1.0 + v.astype("float64"))


def log_magnitude():
    """The pandas UDF (built on demand: creating one needs a live session).
    Pickled by value, so workers need not import this package."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return pandas_udf(_log_magnitude, "double")


def register_all(spark: SparkSession) -> None:
    harmonic.register_sql(spark)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION log_magnitude(v DOUBLE) RETURNS DOUBLE "
              "RETURN log10(1D + v)")
    spark.udf.register("log_magnitude_udf", log_magnitude())
