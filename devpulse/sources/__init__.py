"""Reading, shaping at the edge, and writing."""
