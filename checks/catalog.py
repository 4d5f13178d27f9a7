"""Everything registered."""

from checks import audit, dashboards, gold, ingestion, models, silver, views  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
