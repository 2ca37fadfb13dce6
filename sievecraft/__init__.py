"""Content-filter rule compiler and training-data operators on PySpark."""
