"""Readers and writers of the evaluation tables."""
