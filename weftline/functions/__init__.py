"""weftline functions."""
