"""Analytics over local businesses, their reviews, visitors and check-ins.

Every plan is a function from DataFrames to DataFrames.  Nothing here starts a
session; only the writers, the model fits and ``sources.scratch`` run jobs.
"""
