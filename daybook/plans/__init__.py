"""Named queries: silver/gold models of the activity warehouse and their
twins over the driver tables."""
