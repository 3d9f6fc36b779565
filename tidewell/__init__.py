"""Multi-channel customer, order and inventory analytics on Spark DataFrames."""

from tidewell.settings import Settings

__all__ = ["Settings"]
