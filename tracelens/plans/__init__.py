"""Analyses (J1-J8, V1-V5, X1-X4), table bindings and the query catalogue."""
