"""Operators for preparing large text corpora (training data).  Nothing else in
the package imports this subpackage; ``corpus_pipeline.py`` chains five of the
operators and ``queries.py`` registers one query per operator."""
