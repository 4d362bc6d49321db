"""DataFrame operators: sampling, shaping, batching, retrieval, scoring, reports."""
