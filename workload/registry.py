"""Registration of queries beside their oracles."""

from __future__ import annotations


class Registry:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, oracle: str | None = None):
        def register(fn):
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = oracle
            return fn

        return register
