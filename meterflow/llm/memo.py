"""A bounded memory of results: when its younger half is full, its older half is forgotten."""

from __future__ import annotations

from collections.abc import Callable


class Memo:
    """Results for keys, computed for many new keys at once.

    Long keys are computed each time they occur, which bounds the memory by the number of
    keys. `limit` is per half.
    """

    def __init__(self, compute: Callable[[list], list], limit: int, longest: int):
        self.compute, self.limit, self.longest = compute, limit, longest
        self.young: dict = {}
        self.old: dict = {}

    def known(self, keys: list) -> dict:
        """A mapping that holds the result of each given key."""
        young, old = self.young, self.old
        new = list(set(keys).difference(young))
        if not new:
            return young
        fresh = [key for key in new if key not in old]
        young.update((key, old[key]) for key in new if key in old)
        young.update(zip(fresh, self.compute(fresh)))
        long = [key for key in fresh if len(key) > self.longest]
        if long or len(young) > self.limit:
            kept = dict.fromkeys(long)
            for key in long:
                kept[key] = young.pop(key)
            if len(young) > self.limit:
                self.old, self.young = young, {}
            return young | kept if long else young
        return young
