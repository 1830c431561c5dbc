"""The registered queries: each operator on the given tables, with SQL for the same result.

``QUERIES[name](spark, sf_dir)`` runs the library; ``ORACLES[name]`` is DuckDB SQL over the
same tables. The tables have other names than market data, so each query first gives them
the shape the operator expects.
"""

from . import base, columns, dedup, joins, lake, profile, scalars, tables, workflows  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
