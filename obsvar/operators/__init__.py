"""Operators over annotated-matrix components; every function returns an unexecuted DataFrame."""
