"""Text, search, graph, reporting and linear-classifier operators on PySpark DataFrames."""
