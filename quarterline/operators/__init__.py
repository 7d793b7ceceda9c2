"""DataFrame to DataFrame operators; none of them acts or writes unless its docstring says so."""
