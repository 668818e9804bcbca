"""Splits, scaling, models and scoring on Spark ML."""
