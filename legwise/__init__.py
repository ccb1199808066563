"""Spark-native jobs over the results of yearly multi-leg competitions.

The package turns tables of raw pages or CSV exports into typed tables of legs,
leg rankings and final standings, and derives summaries from them.  Every
operator takes and returns DataFrames (or Columns) and names its columns by
argument, so it runs on any table with the same roles.
"""
