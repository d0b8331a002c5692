"""Retention reporting as DataFrame-to-DataFrame Spark operators.

Landed listings, date scans, activity logs, path listings and catalog tables go
in; one retention verdict per item comes out.  Every operator takes its inputs
as DataFrames and the as-of time as an argument, and stays lazy unless its
docstring says otherwise.
"""
