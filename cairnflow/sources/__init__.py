"""Sources of the registry: landed snapshots, an older corpus, configuration."""
