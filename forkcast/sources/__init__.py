"""Sources and sinks: driver tables, venue CSV, GeoJSON boundaries, writers."""

from forkcast.sources.tables import boundaries_view, read_table, venue_view

__all__ = ["read_table", "venue_view", "boundaries_view"]
