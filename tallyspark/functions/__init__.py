"""Column functions; all of them are built from native expressions."""
