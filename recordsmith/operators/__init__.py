"""recordsmith operators."""
