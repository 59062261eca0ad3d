"""gridlens: daily meter-reading analytics and anomaly scoring on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame API. Python runs on executors only in Arrow-batched steps: the
isolation forest's tree growth (one pandas group per tree), its
vectorised scoring pass, and, for meters too long for one task, the
per-partition tail extraction of the rolling frames.
"""

__version__ = "0.1.0"
