"""Freight operations and finance analytics, expressed as Spark DataFrames."""

from quayside.params import CASE_STUDY, DRIVER, Params

__all__ = ["CASE_STUDY", "DRIVER", "Params"]
