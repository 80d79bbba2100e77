"""Sources and sinks: Kafka-shaped records, current-state tables, warehouse appends."""
