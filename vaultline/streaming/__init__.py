"""Structured Streaming entry points (file landing -> silver)."""

from vaultline.streaming.transactions import start_transaction_stream

__all__ = ["start_transaction_stream"]
