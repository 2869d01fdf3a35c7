"""Union-find over strings; a code point is a string of one character."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable


class UnionFind:
    """Transitive classes with path halving and union by size."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}
        self.size: dict[str, int] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        self.size.setdefault(x, 1)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a == b:
            return
        if self.size[a] < self.size[b]:
            a, b = b, a
        self.parent[b] = a
        self.size[a] += self.size[b]

    def union_all(self, pairs: Iterable[tuple[str, str]]) -> UnionFind:
        for a, b in pairs:
            self.union(a, b)
        return self

    def classes(self) -> dict[str, list[str]]:
        out = defaultdict(list)
        for x in self.parent:
            out[self.find(x)].append(x)
        return {k: sorted(v) for k, v in out.items()}
