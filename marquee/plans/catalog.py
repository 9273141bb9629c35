"""All registered queries; importing the modules fills the registry."""

from marquee.plans import (explorations, ingestion, modelling, mutations, preparation, refreshes,
                           stars)  # noqa: F401
from marquee.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
