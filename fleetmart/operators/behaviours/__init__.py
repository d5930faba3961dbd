"""Behaviour calculators; importing this package registers the built-in ones."""

from fleetmart.operators.behaviours import aviation, maritime  # noqa: F401
from fleetmart.operators.behaviours.core import BEHAVIOURS, behaviour, calculate, qualified, run  # noqa: F401
