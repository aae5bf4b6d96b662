"""Operators for building training corpora on Spark. Nothing else in the library imports this package."""
