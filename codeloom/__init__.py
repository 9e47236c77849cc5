"""Assign classification codes to free-text survey answers with Spark DataFrames."""

from codeloom.config import CodingConfig, SurveyColumns, TargetSpec

__all__ = ["CodingConfig", "SurveyColumns", "TargetSpec"]
