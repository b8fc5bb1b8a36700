"""Sources and sinks: Kafka (stream and bounded), tables, derived feeds."""
