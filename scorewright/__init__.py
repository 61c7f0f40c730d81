"""Model-lifecycle analytics (validate, profile, fit, score, monitor) on Spark DataFrames."""

__version__ = "0.1.0"
