"""tallymark: school-outcome and demographics analytics as PySpark operators.

Every operator is a function from DataFrames and column names to a DataFrame.
Nothing here keeps a session of its own; the caller's session is used.
"""
