"""Operators for building training corpora. Nothing else in folioframe imports this subpackage."""
