"""The registered queries: each with the tables it reads and its SQL twin."""
