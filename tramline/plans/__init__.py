"""The network's tables, each planned from the ones before it."""
