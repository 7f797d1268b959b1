"""Table scans and sinks, the vector store, model weights, domain views."""
