"""Sources and sinks: table loading, the update feed, JSON/text readers,
snapshots and the state table."""
