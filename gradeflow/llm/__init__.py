"""Operators for large-scale training-data pipelines, each by one named method.

Nothing outside this folder (but ``__spark_entry__`` and ``corpus_pipeline``)
imports it.  ``registry`` holds the registered queries and their SQL.
"""
