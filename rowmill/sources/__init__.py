"""Readers, writers, stage files and table checks."""
