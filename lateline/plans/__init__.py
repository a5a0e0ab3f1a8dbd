"""Jobs and registered queries composed from the operators."""
