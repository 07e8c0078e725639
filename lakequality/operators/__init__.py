"""Operators: DataFrame in, DataFrame out, for batch and streaming alike."""
