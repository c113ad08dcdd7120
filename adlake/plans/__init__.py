"""Governed model, reports, graph view and the load job."""
