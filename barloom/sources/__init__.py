"""Where bars come from and go to."""
