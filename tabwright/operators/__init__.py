"""tabwright.operators."""
