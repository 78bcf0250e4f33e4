"""Whole workloads, composed from the operators."""
