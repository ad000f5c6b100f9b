"""Datasets users ask for, composed from the operators."""
