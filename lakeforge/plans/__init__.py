"""Jobs of the reference projects, written on the lakeforge operators.

``catalog.REGISTRY`` holds the registered queries, ``oracle.ORACLE`` the
matching DuckDB SQL.
"""
