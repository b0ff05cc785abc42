"""Running loads on staging files as they arrive (Structured Streaming)."""

from dimforge.streaming.arrivals import account_loader, run_on_arrivals

__all__ = ["account_loader", "run_on_arrivals"]
