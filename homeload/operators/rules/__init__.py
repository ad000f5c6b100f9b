"""Validation rules per document kind, each a column predicate over one document."""
