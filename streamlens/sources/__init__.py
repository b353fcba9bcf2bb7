"""Tables and streams to read."""
