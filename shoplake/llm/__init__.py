"""Operators of a training-data pipeline over web documents, each as a Spark job.

Nothing else in the package imports this subpackage. ``queries`` holds the registered queries.
"""
