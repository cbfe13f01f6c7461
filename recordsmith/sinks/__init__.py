"""recordsmith sinks."""
