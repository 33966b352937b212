"""tabwright.sources."""
