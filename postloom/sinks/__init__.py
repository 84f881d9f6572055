"""File outputs and how they are read back."""
