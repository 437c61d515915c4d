"""Operators for preparing text and vectors for training, each by one stated method."""
