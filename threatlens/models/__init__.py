"""Feature preparation, clustering, forests and series models."""
