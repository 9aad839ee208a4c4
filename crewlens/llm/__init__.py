"""Operators for building training corpora, one module each; their queries are in `queries`."""
