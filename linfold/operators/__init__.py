"""Operators: each takes DataFrames and returns a lazy DataFrame (fits are the only eager steps)."""
