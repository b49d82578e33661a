"""From messages to table rows: one function per kind of event."""

from eventlake.plans.events import bid_rows, flat_ride_rows, nested_ride_rows

__all__ = ["bid_rows", "flat_ride_rows", "nested_ride_rows"]
