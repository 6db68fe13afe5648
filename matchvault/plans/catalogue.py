"""All registered queries."""

from matchvault.plans import (  # noqa: F401
    evaluation_queries,
    feature_queries,
    landing_queries,
    mart_queries,
    serving_queries,
    warehouse,
)
from matchvault.plans.registry import ORACLES, QUERIES  # noqa: F401
