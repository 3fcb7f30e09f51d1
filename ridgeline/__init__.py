"""ridgeline: DataFrame operators for ranking, labelling and relating grouped
activity data (chart-like records, free-text labels, indicator facts) on Spark.

Every operator is a plain DataFrame -> DataFrame transformation. Nothing
collects data to the driver; nothing forces a single partition except where
the input is provably tiny (a handful of rows per shuffle partition).
"""

from ridgeline.session import checkpoint_dir, cluster_conf, get_session, materialize

__all__ = ["get_session", "checkpoint_dir", "cluster_conf", "materialize"]
__version__ = "0.1.0"
