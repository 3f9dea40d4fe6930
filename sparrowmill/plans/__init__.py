"""Multi-step plans: the layered pipeline, dimensional models and the benchmark queries."""
