"""Query registry and the end-to-end pipeline."""
