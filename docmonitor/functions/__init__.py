"""Column functions and the two Arrow helpers."""
