"""Whole jobs: training, scoring, tuning and reports."""
