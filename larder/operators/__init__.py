"""DataFrame operators: ETL, history, co-occurrence, graph, sampling, scoring."""
