"""Plumbline: preparing, auditing, scoring and monitoring labelled portfolios with Spark DataFrames."""
