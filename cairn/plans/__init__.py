"""Physical layout of the lake and the end-to-end pipeline."""
