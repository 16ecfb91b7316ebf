"""Document analytics as Spark jobs: layout, chunks, retrieval, chat and sync."""
