"""Bronze, silver and gold runs composed from the operators."""
