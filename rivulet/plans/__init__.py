"""Named queries over the test tables and their SQL forms."""

from rivulet.plans import boards, forms, geometry, house, paths, proofs, sheets, texts

#: name -> (query, DuckDB form or None)
REGISTRY = boards.QUERIES | house.QUERIES | paths.QUERIES | proofs.QUERIES | geometry.QUERIES | sheets.QUERIES | texts.QUERIES
REGISTRY |= {n: (REGISTRY[n][0], sql) for n, sql in forms.SQL.items()}
