"""DataFrame operators: dictionaries, joins, votes, rankings, features, write-back."""
