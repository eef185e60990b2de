"""Spark jobs for the data side of language-model training and chat."""
