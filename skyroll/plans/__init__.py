"""User-level queries and the named query catalog."""
