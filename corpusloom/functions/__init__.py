"""Part of corpusloom; see the module names."""
