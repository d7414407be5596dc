"""Where tables come from: the star schema read as business tables, landed records, databases."""
