"""Composition: bindings on the test tables, the query catalogue and its SQL twins, the full build."""
