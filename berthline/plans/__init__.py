"""Composite jobs (cleaning, scoring) and the registered query catalog."""
