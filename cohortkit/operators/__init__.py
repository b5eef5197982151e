"""DataFrame operators: base joins, measures, coverage, tags, similarity, chains."""
