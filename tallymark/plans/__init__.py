"""Physical strategies shared by the operators: lineage cuts, ordered scans, skew joins."""
