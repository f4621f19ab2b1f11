"""Partner and order performance reporting on Spark DataFrames."""

from partnerscope.params import Department, ReportParams, default_params

__all__ = ["Department", "ReportParams", "default_params"]
