"""docloom operators."""
