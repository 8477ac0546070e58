"""Streaming extension: case results as a stream. Beyond the batch operators; same verdict columns."""
