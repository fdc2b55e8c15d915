"""Ready-made jobs: ingestion flows and the registered queries."""
