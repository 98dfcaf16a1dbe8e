"""Readers: event tables, file inventories and generic event logs."""
