from . import feature_store, raw_files, results, warehouse

__all__ = ["feature_store", "raw_files", "results", "warehouse"]
