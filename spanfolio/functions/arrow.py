"""Arrow functions in plans."""

from __future__ import annotations


def once(function):
    """Keep the optimizer from evaluating an expensive Arrow function twice.

    A deterministic function may be copied into a filter that is pushed below
    the projection that uses it, and would then run for both.
    """
    return function.asNondeterministic()
