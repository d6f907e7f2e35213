"""Feature groups as data, and the jobs that run them."""
