"""Plans: the materialize-once pipeline, the query catalog and the SQL oracle."""
