"""DataFrame in, DataFrame out. Every operator is lazy unless its docstring says that it writes."""
