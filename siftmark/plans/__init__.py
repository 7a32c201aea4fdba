"""Named results composed from the operators."""
