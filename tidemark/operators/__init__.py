"""DataFrame -> DataFrame operators. Lazy, free of I/O, shared by batch and streaming."""
