"""Event analytics on PySpark: typed operators over batch and streaming DataFrames."""
