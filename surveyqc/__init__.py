"""Review of coded survey answers against their narratives, on Spark DataFrames."""

from surveyqc.operators.prompts import Prompts
from surveyqc.options import SurveyOptions
from surveyqc.plans.full_run import ReviewRun, run_review

__all__ = ["Prompts", "ReviewRun", "SurveyOptions", "run_review"]
