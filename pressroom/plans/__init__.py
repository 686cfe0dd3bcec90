"""Whole jobs: feature pipelines, training, tuning and prediction."""
