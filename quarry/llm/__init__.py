"""Operators for building language-model training corpora on Spark.

Nothing outside this package imports it, so a deployment without corpus work
may leave the folder out.
"""
