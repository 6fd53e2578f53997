"""Procurement analytics as lazy Spark jobs: tables and parameters in, DataFrame out."""
