"""weftline plans."""
