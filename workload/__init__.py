"""Registered queries: inputs derived from the test tables, the library run on them, and an SQL oracle for each."""
