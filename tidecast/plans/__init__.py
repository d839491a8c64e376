"""Compositions of operators: the feature table, the daily job, the query catalog."""
