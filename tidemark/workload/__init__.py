"""The registered queries: each job run over the given tables, with its SQL twin."""

from . import batch, files, star, streams  # noqa: F401  (they register their queries)
from .registry import QUERIES

__all__ = ["QUERIES"]
