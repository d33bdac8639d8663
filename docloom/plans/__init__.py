"""docloom plans."""
