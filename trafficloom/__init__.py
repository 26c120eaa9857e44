"""Spark jobs that turn landed road-traffic counts into one checked feature table."""
