"""quarry — Spark-native analytics operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL / Structured Streaming / Spark ML primitives.  Nothing in the
library collects rows to the driver; all heavy work runs in Spark tasks.
"""

from quarry.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
