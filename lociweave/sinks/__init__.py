"""Writers; each takes an explicit path and returns it."""
