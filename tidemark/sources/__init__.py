"""Sources and sinks. Schemas are given, never inferred."""
