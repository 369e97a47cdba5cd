"""Operators of training-data pipelines over documents, conversations and benchmarks.

Nothing else in the package imports this folder. Internal columns are called ``__ll_*``, so that
extra columns of a caller never clash with them.
"""
