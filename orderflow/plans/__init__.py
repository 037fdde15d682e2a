"""Whole plans: the publishing steps, and the queries over the supplied tables."""
