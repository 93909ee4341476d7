"""Composite plans: the public recommenders (E1-E9), the staged pipeline
and the registry of named queries used by ``__spark_entry__``."""
