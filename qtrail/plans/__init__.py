"""Jobs: the daily / ranged events build (X4, X5), the history build (X3),
and table maintenance (S8-S13)."""
