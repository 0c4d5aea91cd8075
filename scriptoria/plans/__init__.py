"""Requests composed of operators."""
