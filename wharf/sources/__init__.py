"""Scans: raw broker records to envelopes, start positions, intake limits."""
