"""Operators for training-data pipelines. Nothing else in the library imports
this subpackage; it is registered by ``__spark_entry__`` when present."""
