"""Operators for training-data pipelines, on Spark tables of documents, vectors and pages."""
