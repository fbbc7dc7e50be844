"""DataFrame-to-DataFrame operators, for batch and streaming input alike."""
