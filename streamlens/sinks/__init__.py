"""Where batches and messages are written."""
