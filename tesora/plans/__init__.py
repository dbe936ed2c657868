"""Whole tables composed from the operators."""
