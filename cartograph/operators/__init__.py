"""DataFrame -> DataFrame operators. None of them starts a session; only the iterative
ones (k-means, PersonalRank) run jobs, and those bring back bounded results only."""
