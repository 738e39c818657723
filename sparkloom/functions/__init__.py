"""See the README for what lives in `functions`."""
