"""Spark-native analytics over keyed observations and published weight tables."""

__version__ = "0.1.0"
