"""Structured Streaming: live roll-ups, running answers and online clusters."""
