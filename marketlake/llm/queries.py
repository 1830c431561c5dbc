"""All queries of this package."""

from . import (  # noqa: F401
    bpe,
    lexical,
    maxent,
    maxscore,
    neardup,
    packing,
    pages,
    pii,
    quality,
    sharding,
    syncmers,
    toxicity,
    whitening,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
