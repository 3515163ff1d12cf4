"""Caller's models in Python workers (L1-L3).

A hook takes a factory, not a model: the factory travels with the task, runs once in
each Python worker, and what it builds is kept there for all batches and tasks the
worker answers. A model is thus never pickled, and is loaded as often as there
are workers, not as there are batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

_HELD: dict[str, Any] = {}


def once_a_worker(factory: Callable[[], Any]) -> Callable[[], Any]:
    """A function that returns the worker's own instance of ``factory()``."""
    key = uuid.uuid4().hex

    def held() -> Any:
        from threadmill.operators import hooks  # the worker's module, not a copy in the closure

        if key not in hooks._HELD:
            hooks._HELD[key] = factory()
        return hooks._HELD[key]

    return held
