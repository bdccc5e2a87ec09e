"""Spark-native reconstruction of agent dialogue turns from tracing spans."""
