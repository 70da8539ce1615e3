"""Distributed operators: ordering primitives (global index, rolling
statistics, running totals, fills, rank), sensor cleaning, time split,
evaluation metrics, GBT training and scoring, tree attributions and
root-cause selection."""
