"""wharf: message bridging, relay and delivery audit as Spark jobs."""

from wharf.session import configure

__all__ = ["configure"]
