"""The registered queries: each key pairs a Spark query with, where SQL can say it, the same result in SQL."""

from workload.registry import ORACLES, QUERIES  # noqa: F401
from workload import sources, description, cleaning, binning, testing, modelling, classifying, reporting  # noqa: F401,E402
