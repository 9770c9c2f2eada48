"""Listening analytics and recommendation as Spark DataFrame operators."""
