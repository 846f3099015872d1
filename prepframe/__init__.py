"""prepframe: table preparation, Spark ML training/scoring and one-pass evaluation.

Every operator takes and returns Spark DataFrames and stays lazy until the caller
writes or collects; fitted parameters are small DataFrames.  Sub-packages:

* ``sources``   readers / writers for CSV, Parquet, JSON, catalog tables, models
* ``functions`` Column-level helpers (safe casts, scaling functions)
* ``operators`` DataFrame -> DataFrame operators (prep, reshape, features, models, metrics)
* ``plans``     the registered queries over the driver tables and their SQL twins
* ``streaming`` fitted operators applied to streaming frames
"""

from prepframe._session import checkpoint_dir, cut_lineage  # noqa: F401

__version__ = "0.1.0"
