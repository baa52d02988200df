"""Jobs, the flagship report and the registry of checked queries."""
