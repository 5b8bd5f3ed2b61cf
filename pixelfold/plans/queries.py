"""All registered queries; importing the modules fills the registry."""

from . import (  # noqa: F401
    catalog_queries,
    composite_queries,
    file_queries,
    focal_queries,
    pixel_queries,
    polygon_queries,
    series_queries,
    stream_queries,
    warp_queries,
    zone_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
