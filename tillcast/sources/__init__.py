"""Readers and writers of the raw and published layers."""
