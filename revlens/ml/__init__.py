"""Spark ML features, training, evaluation and scoring."""
