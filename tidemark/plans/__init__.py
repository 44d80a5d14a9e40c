"""Plan shapes that Catalyst does not choose by itself, and whole loads."""
