"""Column functions of the registry."""
