"""Jobs that put operators together: the store, loading, the registered queries."""
