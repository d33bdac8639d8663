"""docloom sources."""
