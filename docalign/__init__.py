"""Bring semi-structured records from many old layouts into one, at scale."""
