"""Formline: ordered features, ratings, splits, metrics and match/text/graph jobs on PySpark."""
