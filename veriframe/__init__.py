"""Table verification and data-quality operators for Spark.

Every operator takes DataFrames and returns a DataFrame: verdicts, metrics and
gate results stay on the cluster until the caller asks for them.
"""
