"""Written tables, parameter sets and whole runs."""
