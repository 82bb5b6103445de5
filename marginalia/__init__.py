"""Document-structure, retrieval and entity-resolution analytics on PySpark DataFrames."""
