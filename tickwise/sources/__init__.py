"""Table adapters, file formats and sinks."""
