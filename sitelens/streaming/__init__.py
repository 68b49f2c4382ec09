"""Late-arriving data: landing-date increments and restated partitions."""
