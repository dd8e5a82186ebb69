"""Operators of a training-data pipeline, one module each; `queries` registers op1 to op10."""
