"""Sources and sinks: driver tables, triples, code lists, rates, nested JSON tenders."""
