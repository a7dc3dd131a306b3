"""Spark operators: latest version, ranks, quantiles, history, data tests, expectations, monitoring."""
