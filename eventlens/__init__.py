"""eventlens: product analytics on Spark DataFrames.

Every public operator takes DataFrames and returns a DataFrame (model fits
return a fitted model plus DataFrames).  Nothing passes whole through the
driver: the only collects are one-row aggregates, fitted model parameters
and bounded samples whose size is a parameter.
"""

__all__ = ["session"]
