"""The day-ahead jobs, each a plan over any number of days and series."""
