"""millrace: DataFrame-in / DataFrame-out operators for batch text and CSV
ETL, feature preparation, Spark ML training and evaluation, and stream
decoding and scoring. All work runs on Spark executors."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run inside tasks (Arrow batch codecs,
# vectorised UDFs) are shipped by value, so executors need no installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from millrace.session import build_session, shared_path  # noqa: E402

__all__ = ["build_session", "shared_path"]
