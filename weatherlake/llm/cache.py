"""A bounded memory of results by key, for workers that meet frequent keys again and again."""

from __future__ import annotations


class Recent(dict):
    """Forgets keys not asked for lately: when `limit` new ones have come, those of the generation before go."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def find(self, keys: list) -> list:
        """The value of each key that is remembered, None for the others."""
        values = list(map(self.get, keys))
        before = self.before
        again = {}
        for i, value in enumerate(values):
            if value is None and (value := before.get(keys[i])) is not None:
                values[i] = again[keys[i]] = value
        self.put_all(again)
        return values

    def put(self, key, value) -> None:
        self._make_room()
        self[key] = value

    def put_all(self, values: dict) -> None:
        self._make_room()
        self.update(values)

    def _make_room(self) -> None:
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
