"""Result tailing, live progress and terminal events as Structured Streaming jobs."""
