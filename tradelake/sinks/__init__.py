"""Sink adapters: tables and Kafka."""
