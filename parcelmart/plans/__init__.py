"""The load job, the nine analytical queries and the report views."""
