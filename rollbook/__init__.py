"""Load, clean, check, lay out and search company-registry extracts with Spark."""

from rollbook.schema import REGISTRY, Field, Table
from rollbook.session import tune, workspace

__all__ = ["REGISTRY", "Field", "Table", "tune", "workspace"]
