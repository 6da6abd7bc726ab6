"""Job plans, sinks and the catalog of checked queries."""
