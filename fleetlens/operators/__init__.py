"""DataFrame operators: they take and return DataFrames."""
