"""Source adapters: Kafka, files, tables, ticks."""
