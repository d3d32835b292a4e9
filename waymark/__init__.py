"""Trajectory, manifest and point-cloud analytics as Spark DataFrames."""
