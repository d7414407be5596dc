"""Combinators over DataFrames: lookups, ranking, reshaping."""
