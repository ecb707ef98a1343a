"""weftline sources."""
