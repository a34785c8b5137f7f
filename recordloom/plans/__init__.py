"""Whole flows: profiling, evaluation, experiments, training and inference."""
