"""Jobs, and the registered queries over the supplied tables."""
