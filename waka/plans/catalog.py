"""Import every catalog module so its queries register, then expose them."""

from __future__ import annotations

from . import (  # noqa: F401
    catalog_c4,
    catalog_features,
    catalog_misc,
    catalog_network,
    catalog_profile,
    catalog_realtime,
    catalog_streaming,
    catalog_tables,
)
from .registry import NOTES, ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES", "NOTES"]
