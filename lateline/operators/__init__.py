"""DataFrame-to-DataFrame operators and their fitted state."""
