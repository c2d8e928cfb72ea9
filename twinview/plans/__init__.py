"""Whole jobs."""

from twinview.plans.batch import run_batch_views
from twinview.plans.speed import start_pipeline

__all__ = ["run_batch_views", "start_pipeline"]
