"""Pathogen-sequencing surveillance on Spark DataFrames."""
