"""Records, edges, upserts and paths as DataFrame operators."""
