"""All registered queries (importing the catalog modules registers them)."""

from voltwatch.plans import catalog_features  # noqa: F401
from voltwatch.plans import catalog_hot  # noqa: F401
from voltwatch.plans import catalog_io  # noqa: F401
from voltwatch.plans import catalog_models  # noqa: F401
from voltwatch.plans import catalog_profiles  # noqa: F401
from voltwatch.plans import catalog_streams  # noqa: F401
from voltwatch.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
