"""Raw sources, staged tables and report sinks."""
