"""Data jobs over tables, written as PySpark DataFrame functions."""
