"""Deliveries that arrive while the warehouse is running."""
