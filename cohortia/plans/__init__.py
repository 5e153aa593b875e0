"""Jobs: the order in which operators build the report tables."""
