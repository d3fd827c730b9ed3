"""Operators: filters, aggregations, joins, imputation, encoding, splits,
models and evaluation, each a DataFrame transform or a distributed job."""
