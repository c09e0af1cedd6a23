"""Sinks: stored tables, per-micro-batch writers, Kafka and JDBC."""
