"""The registered queries; importing the modules fills the registry."""

from ledgerlark.plans import (  # noqa: F401
    changes,
    customers,
    documents,
    filters,
    layout,
    months,
    pivots,
    quality,
    reports,
    subqueries,
    windows,
)
from ledgerlark.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
