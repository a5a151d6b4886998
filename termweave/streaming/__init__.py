"""Edit tracking over a log, as a batch or as a stream."""
