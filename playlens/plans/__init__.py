"""Driver-table roles and the registered queries."""
