"""goldrow: master-data building on Spark DataFrames.

Every public transform takes DataFrames plus a small frozen spec and returns a
DataFrame; nothing holds a session at module level.
"""
