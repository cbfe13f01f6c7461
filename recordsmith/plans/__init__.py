"""recordsmith plans."""
