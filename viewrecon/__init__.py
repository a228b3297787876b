"""Reconciles a base table with a derived, re-keyed copy of it, and plans repairs, on Spark DataFrames."""
