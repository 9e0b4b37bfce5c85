"""The same operators on unbounded input, and sinks."""
