"""Readers: reports, the batch catalogue, patches and landed market data."""
