"""Spark jobs over structural-variant cohorts."""
