"""tabwright.plans."""
