"""The steps of a refresh run; each takes DataFrames and returns a lazy DataFrame."""
