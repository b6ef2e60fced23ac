"""Complete jobs put together from the operators."""
