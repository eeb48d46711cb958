"""Composite plans: the derived quote view, model tables, reports and the
query catalog used by ``__spark_entry__``."""
