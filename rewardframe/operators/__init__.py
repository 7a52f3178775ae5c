"""DataFrame -> DataFrame operators built on joins, aggregates and windows."""
