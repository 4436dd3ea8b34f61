"""Whole jobs: preparation, training and scoring."""
