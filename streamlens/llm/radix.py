"""An adaptive radix tree over byte keys: nodes grow with their children, paths are compressed."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class _Sorted:
    """Up to 4 or 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("room", "bytes", "kids")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte: int) -> "Node | None":
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid: "Node"):
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.room:
            grown = _Sorted(16) if self.room == 4 else _Indexed()
            for b, k in zip(self.bytes, self.kids):
                grown.put(b, k)
            return grown.put(byte, kid)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return zip(self.bytes, self.kids)


class _Indexed:
    """Up to 48 children behind a table of 256 places."""

    __slots__ = ("place", "kids")

    def __init__(self):
        self.place, self.kids = bytearray(256), []

    def get(self, byte: int) -> "Node | None":
        at = self.place[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid: "Node"):
        at = self.place[byte]
        if at:
            self.kids[at - 1] = kid
            return self
        if len(self.kids) == 48:
            grown = _Direct()
            for b, k in self.items():
                grown.put(b, k)
            return grown.put(byte, kid)
        self.kids.append(kid)
        self.place[byte] = len(self.kids)
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return ((b, self.kids[at - 1]) for b, at in enumerate(self.place) if at)


class _Direct:
    """A child or none for each of 256 bytes."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte: int) -> "Node | None":
        return self.kids[byte]

    def put(self, byte: int, kid: "Node"):
        self.kids[byte] = kid
        return self

    def items(self) -> Iterator[tuple[int, "Node"]]:
        return ((b, k) for b, k in enumerate(self.kids) if k is not None)


class Node:
    """``path`` are the bytes below the parent's byte; ``value`` is that of the key that ends here."""

    __slots__ = ("path", "value", "below", "found")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.below, self.found = path, value, None, None

    def items(self) -> Iterator[tuple[int, "Node"]]:
        """Children by their bytes, in order."""
        return self.below.items() if self.below is not None else iter(())

    def add(self, byte: int, kid: "Node") -> None:
        self.below = (self.below or _Sorted()).put(byte, kid)


def _shared(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``path`` stand in ``key`` from ``at``; halved, so long paths are fast."""
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(path[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Tree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        """Add ``key``; a key that is there gets the new value."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at, above, byte = self.root, 0, None, 0
        while True:
            same = _shared(node.path, key, at)
            if same < len(node.path):
                upper = Node(node.path[:same])
                upper.add(node.path[same], node)
                node.path = node.path[same + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.add(byte, upper)
                node = upper
            at += same
            if at == len(key):
                node.value = value
                return
            kid = node.below.get(key[at]) if node.below is not None else None
            if kid is None:
                node.add(key[at], Node(key[at + 1 :], value))
                return
            above, byte, node, at = node, key[at], kid, at + 1

    def bottom_up(self) -> Iterator[tuple[Node, int, int]]:
        """``(node, start, end)``, children first; its edge spans the key bytes start to end."""
        todo = [(self.root, 0, False)] if self.root is not None else []
        while todo:
            node, start, seen = todo.pop()
            end = start + len(node.path)
            if seen:
                yield node, start, end
                continue
            todo.append((node, start, True))
            # The byte that leads to a child belongs to the edge above it.
            todo.extend((kid, end + 1, False) for _, kid in node.items())
