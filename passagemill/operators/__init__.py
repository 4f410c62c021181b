"""DataFrame operators: chunking, search, answers, table mutation."""
