"""Dataflow operators: rules, change capture, keys, star lookups, metrics, bookings."""
