"""Reusable steps over DataFrames: parent completion, dense ids, constraint checks, the window."""
