"""DataFrame operators: rule matching, joins, aggregates, label-document merges."""
