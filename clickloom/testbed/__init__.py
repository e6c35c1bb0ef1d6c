"""Clickstream inputs derived from the given ``events``, ``part``, ``customer`` and ``nation`` tables."""
