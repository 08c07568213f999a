"""Readers and writers of annotation text formats, and the projection of the test tables."""
