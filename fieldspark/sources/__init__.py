"""Landed tables in, typed tables and snapshots out."""
