"""A bounded memory of a function's results."""

from __future__ import annotations


class Remembered(dict):
    """d[x] is f(x), computed on first use. Emptied when it holds `most` entries, so a task's memory stays bounded."""

    def __init__(self, f, most: int = 250_000, longest: int = 64):
        super().__init__()
        self.f, self.most, self.longest = f, most, longest

    def __missing__(self, key):
        value = self.f(key)
        if len(key) <= self.longest:  # long keys hardly come again
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class RememberedOften(Remembered):
    """The same, but keys in use outlive the emptying: a full half becomes the older one, which gives back what is asked for
    again before the next half fills. At most `most` entries in both halves."""

    def __init__(self, f, most: int = 250_000, longest: int = 64):
        super().__init__(f, most, longest)
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.f(key)
        if len(key) <= self.longest:
            if len(self) >= self.most // 2:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
