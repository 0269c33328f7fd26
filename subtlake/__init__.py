"""Subtitle-archive analytics as Spark jobs."""
