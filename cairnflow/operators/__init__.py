"""Set-based operators of the registry."""
