"""Complete plans: the event view over the test tables, the registered queries, full runs."""
