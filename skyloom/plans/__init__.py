"""Composed data flows and the registered queries."""
