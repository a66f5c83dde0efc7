"""quarry: a Spark-native feature / training-set / scoring / audit engine.

Every operator is a function ``f(df, ...) -> DataFrame`` whose work runs on
the executors.  Subpackages:

* ``sources``   – table readers, versioned snapshots, sinks, ingest
* ``functions`` – column expressions (digests, time helpers, URIs)
* ``operators`` – windows, as-of join, splits, metrics, preprocessing,
                  model fit/score, registry tables, monitoring
* ``plans``     – end-to-end jobs (train, batch score) and the registered
                  query catalogue used by ``__spark_entry__``
* ``streaming`` – micro-batch sink for the batch-scoring operator
"""

from quarry.session import get_session, checkpoint_dir  # noqa: F401
from quarry.spec import FeatureSpec  # noqa: F401

__all__ = ["get_session", "checkpoint_dir", "FeatureSpec"]
