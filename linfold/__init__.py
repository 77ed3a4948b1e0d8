"""linfold: tabular regression on Spark - profile, correlate, prune, split, encode, tune, evaluate, score."""

__version__ = "0.1.0"
