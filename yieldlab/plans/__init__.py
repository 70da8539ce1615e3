"""Composed plans: the analytical views, data-quality checks, the end-to-end
analysis, and the query catalog / oracle SQL used by ``__spark_entry__``."""
