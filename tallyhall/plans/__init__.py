"""Star-schema role map, marts, measures and the query catalog."""
