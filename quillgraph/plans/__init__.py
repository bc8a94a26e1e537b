"""The graph, its questions, checks and loads."""
