"""Expected-credit-loss analytics on Spark DataFrames.

``functions``  scalar column expressions (dates, delinquency, annuities, normal law)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and writers (raw files, warehouse tables, feature store, results)
``plans``      whole stages assembled from operators
``streaming``  incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"
