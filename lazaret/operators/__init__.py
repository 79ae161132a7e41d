"""DataFrame operators, the same for batch and micro-batch."""
