"""Data sets and reports as plain functions of DataFrames."""
