"""Query catalog over the driver tables.

Importing this package registers every query module; ``queries()`` and
``oracle_sql()`` feed ``__spark_entry__.py``, the bench and the tests.
"""

from __future__ import annotations

from millrace.plans import (column_queries, eval_queries, feature_queries,  # noqa: F401
                            io_queries, model_queries, quality_queries, stream_queries,
                            text_queries, tuning_queries)
from millrace.plans import registry


def queries():
    return {name: reg.fn for name, reg in registry.REGISTRY.items()}


def oracle_sql():
    return {name: reg.sql for name, reg in registry.REGISTRY.items() if reg.sql}
