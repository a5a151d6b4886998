"""Source schemas, readers and sinks."""
