"""Text-classification experiments as Spark jobs.

Sampling and folds, text cleaning, term features, linear learners, scores, error reports,
run-log audits and batch or stream scoring, all on DataFrames.
"""
