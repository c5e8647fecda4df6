"""Where chunks come from and go to."""
