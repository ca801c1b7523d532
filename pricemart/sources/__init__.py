"""Table and feed sources and sinks."""
