"""Report builders and the batch runner."""
