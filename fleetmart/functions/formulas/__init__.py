"""Importing this package registers every built-in formula."""

from fleetmart.functions.formulas import aviation, maritime  # noqa: F401
