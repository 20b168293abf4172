"""Staging models, marts, summaries and measures: plain functions from DataFrames to DataFrames."""
