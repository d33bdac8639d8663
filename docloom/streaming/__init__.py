"""docloom streaming."""
