"""Plate-screen image analytics as Spark jobs."""
