"""DataFrame -> DataFrame operators.  Column names, widths, windows and
category lists are arguments, so the same operator runs on property
tables and on fixture frames."""
