"""Reward-customer segmentation on Spark DataFrames."""

from rewardseg.params import RunParams
from rewardseg.plans.pipeline import Run, publish_run, run_segmentation

__all__ = ["RunParams", "Run", "publish_run", "run_segmentation"]
