"""recordsmith sources."""
