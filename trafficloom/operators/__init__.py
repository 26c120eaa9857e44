"""DataFrame operators: joins, groupings, reshaping, checks and tile tables."""
