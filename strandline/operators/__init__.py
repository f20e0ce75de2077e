"""Relational operators over the channel graph: pure functions from DataFrames to DataFrames."""
