"""Ready-made plans put together from the operators."""
