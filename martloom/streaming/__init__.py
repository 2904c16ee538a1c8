"""Publishing as a stream."""
