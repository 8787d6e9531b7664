"""DataFrame operators: chunking, snapshot diff, table maintenance, search, prompts."""
