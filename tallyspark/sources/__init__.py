"""Sources: declared schemas and readers."""
