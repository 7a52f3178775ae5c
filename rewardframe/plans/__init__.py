"""Bindings of the driver tables to rollout concepts and the registered queries."""
