"""Scalar functions: Column to Column, all in Spark's own expressions."""
