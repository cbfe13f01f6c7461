"""recordsmith functions."""
