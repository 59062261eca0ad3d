"""Column expressions (pure ``pyspark.sql.functions`` compositions)."""

from gridlens.functions.derive import *  # noqa: F401,F403
