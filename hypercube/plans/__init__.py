"""Published bundle and the registry of named queries."""
