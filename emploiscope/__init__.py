"""Job-market and territorial analytics on Spark DataFrames.

Every public operator takes DataFrames (or Columns) and returns a lazy DataFrame (or
Column); nothing runs until the caller writes, checks or collects. Sessions must run in
UTC with ANSI mode on (``emploiscope.session`` sets both).
"""
