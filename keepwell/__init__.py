"""Customer-retention analytics on Spark DataFrames."""

from keepwell.params import Params

__all__ = ["Params"]
