"""Deliveries, status changes and publications as they arrive."""
