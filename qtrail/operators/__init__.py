"""Relational operators of the audit: enrichment (J1 J2 U1), classification
(X1 J3 A13 J4 A14), history ingest (P9 P10 F6 F7) and the reports (A2-A12)."""
