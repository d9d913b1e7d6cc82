"""gavelcast: tabular price modelling on Spark DataFrames."""

from .params import Settings

__all__ = ["Settings"]
