"""Plans: the registered queries, their SQL oracles and the mart build."""
