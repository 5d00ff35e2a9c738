"""Incremental operation: new trail files trigger the same idempotent
(region, day) rebuild the batch job performs, so late deliveries are picked
up without a manual re-run."""
