"""docloom functions."""
