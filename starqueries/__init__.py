"""Queries over the provided tables, and the same results in plain SQL.

``standins`` derives inputs with misses, NULLs and odd values from the tables,
``registry`` runs the package's operators over them, ``oracle`` states each
expected result as SQL, ``compare`` checks one against the other.
"""
