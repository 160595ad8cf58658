"""Sources (readers, the test-table bindings) and sinks (layer writers,
publishing)."""
