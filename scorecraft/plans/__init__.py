"""Composed plans (study preparation, cleaning steps, audit) and the query
catalogue used by ``__spark_entry__``."""
