"""Raw table sources, the test-data adapter and sinks."""
