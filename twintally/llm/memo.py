"""Bounded tables of what was worked out before."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """Values by key, with those of an older generation at hand.

    When the table has grown beyond ``most`` it becomes the older generation and what
    was the older one is forgotten, so keys that keep coming stay and at most about twice
    ``most`` entries and one batch's are held.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self.older: dict = {}

    def look_up(self, keys: set, learn: Callable[[set], dict]) -> dict:
        """A table of just these keys: kept, taken from the older generation or learnt."""
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        found, missing = {}, set()
        own, older = self.get, self.older.get
        for key in keys:
            value = own(key)
            if value is None:
                value = older(key)
                if value is None:
                    missing.add(key)
                    continue
                self[key] = value
            found[key] = value
        if missing:
            learnt = learn(missing)
            self.update(learnt)
            found |= learnt
        return found


class Learnt(dict):
    """Values by key, worked out one by one when they are first asked for; as bounded as a :class:`Memo`."""

    def __init__(self, most: int, learn: Callable):
        super().__init__()
        self.most = most
        self.learn = learn
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.learn(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
