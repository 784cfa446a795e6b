"""Query jobs (section D), comps (E2) and signal reports."""
