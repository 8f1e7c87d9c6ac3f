"""Imports every query module and exposes what they registered."""

from verdictlake.plans import (analysis_queries, config_queries, replay_queries,  # noqa: F401
                               scorecard_queries, streaming_queries)
from verdictlake.plans.registry import ORACLES, QUERIES  # noqa: F401
