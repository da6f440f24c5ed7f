"""Reading and writing sets of fragments."""
