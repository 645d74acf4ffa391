"""DataFrame to DataFrame operators over files, lines, chunks, traces, vectors and graphs."""
