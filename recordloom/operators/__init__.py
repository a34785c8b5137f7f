"""Candidate generation, selection and pair features, DataFrame to DataFrame."""
