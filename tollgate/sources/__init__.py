"""Sources: reference tables, files, message streams, Kafka and JDBC."""
