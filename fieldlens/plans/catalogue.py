"""All registered queries."""

from fieldlens.plans import catalogue_raster, catalogue_spatial, catalogue_tables, catalogue_text  # noqa: F401
from fieldlens.plans.registry import ORACLES, QUERIES  # noqa: F401
