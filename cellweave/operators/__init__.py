"""Operators over DataFrames: grids, time, labels, sampling, statistics, metrics, learning."""
