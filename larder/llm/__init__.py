"""Operators of a training-data pipeline. Nothing else in larder imports this subpackage."""
