"""The library's operators run over the given tables, each with the SQL that must agree."""

from workload import bodies, changes, citing, indexes, matching, media, publishing, scans, texts, topics  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
