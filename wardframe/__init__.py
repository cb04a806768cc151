"""wardframe: data contracts, profiling, split checks, model validation and batch scoring on Spark.

Every operator takes a DataFrame plus column names and returns a DataFrame (or a fitted model
whose ``transform`` is made of plain ``Column`` expressions).
"""
