"""Training-data operators: one module per operator, general interfaces in each.

Nothing outside this package imports it.  Workers import it by name, so a
cluster needs the repository on its Python path (``--py-files`` or an
installed package).
"""
