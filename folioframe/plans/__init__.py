"""Named queries over the plain tables, and their SQL."""

from . import gathering, judging, keeping, nesting, normalizing, producing, replaying, semantic, spanning, structural  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
