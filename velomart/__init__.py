"""Spark-first analytics for shared-mobility trips and station-status feeds."""

from velomart.params import Params

__all__ = ["Params"]
