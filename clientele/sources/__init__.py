"""Reading, checking and writing the tables the operators work on."""
