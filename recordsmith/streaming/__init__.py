"""recordsmith streaming."""
