"""Composed jobs: the layered warehouse build, the query registry, and the
SQL statements each registered query is checked against."""
