"""Retail sales and churn marts as PySpark DataFrame functions."""

from salesmarts.plans.config import PipelineConfig
from salesmarts.plans.pipeline import run_pipeline

__all__ = ["PipelineConfig", "run_pipeline"]
