"""Spark-first engine for scanned questionnaires, their cohort tables and training-data pipelines."""
