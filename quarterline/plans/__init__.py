"""What operators are put together to: layer loads, serving, and the registered queries."""
