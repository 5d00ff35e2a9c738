"""Readers: audit-trail JSON (S1), query history JSON lines (S2), raw
execution dumps (S3 input), the enriched events table (S5), the tier map
(S16), and audit inputs derived from the driver's tables."""
