"""Every registered query, with its check in SQL where SQL can express it."""

import sys

from pyspark import cloudpickle

from registry import (  # noqa: F401
    caching, cleaning, duplicates, enrichment, learning, matching, reports, sources, streams,
)
from registry.core import ORACLES, QUERIES  # noqa: F401

# The functions that stand in for models travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
