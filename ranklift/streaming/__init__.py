"""Stateless operators applied to streaming DataFrames."""
