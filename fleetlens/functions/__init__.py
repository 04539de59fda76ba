"""Column-expression helpers (all Spark built-ins, no Python UDF)."""

from fleetlens.functions import classify, dates, numbers, text  # noqa: F401
