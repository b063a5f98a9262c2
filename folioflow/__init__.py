"""Document publishing analytics as table-to-table Spark operators."""

from folioflow.settings import Site

__all__ = ["Site"]
