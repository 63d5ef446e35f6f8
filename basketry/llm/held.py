"""What a Python worker keeps from task to task: one thing at a time.

Workers live as long as their executor and serve one operator after the other. Tables and remembered
tokens of an operator help its later tasks, but must not stay when the next operator needs the memory.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_kept: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """The worker's object of that key; it is made anew, and the former one dropped, if the key has changed."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]
