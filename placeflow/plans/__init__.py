"""Query plans: the registered queries and the run/work-item plans."""
