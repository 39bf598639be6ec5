"""Operators for preparing large-scale training corpora (optional subpackage)."""
