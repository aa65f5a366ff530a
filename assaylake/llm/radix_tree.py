"""Adaptive radix trees: byte tries with compressed paths, whose nodes change their layout with the number of children."""

from __future__ import annotations

from collections.abc import Iterator


class Sparse:
    """Up to 4, then up to 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("prefix", "value", "room", "bytes", "kids")

    def __init__(self, prefix: bytes, value: int = -1):
        self.prefix, self.value, self.room = prefix, value, 4
        self.bytes, self.kids = bytearray(), []

    def find(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, kid):
        """Adds or replaces a child; returns the node that now stands here."""
        at = self.bytes.find(byte)
        if at >= 0:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.room:
            if self.room == 16:
                return Indexed(self).put(byte, kid)
            self.room = 16
        at = sum(b < byte for b in self.bytes)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def children(self) -> Iterator:
        return iter(self.kids)


class Indexed:
    """Up to 48 children: a table of 256 places into their list."""

    __slots__ = ("prefix", "value", "places", "kids")

    def __init__(self, small: Sparse):
        self.prefix, self.value, self.kids = small.prefix, small.value, list(small.kids)
        self.places = bytearray(b"\xff" * 256)
        for at, byte in enumerate(small.bytes):
            self.places[byte] = at

    def find(self, byte: int):
        at = self.places[byte]
        return None if at == 255 else self.kids[at]

    def put(self, byte: int, kid):
        at = self.places[byte]
        if at != 255:
            self.kids[at] = kid
            return self
        if len(self.kids) == 48:
            return Full(self).put(byte, kid)
        self.places[byte] = len(self.kids)
        self.kids.append(kid)
        return self

    def children(self) -> Iterator:
        return (self.kids[at] for at in self.places if at != 255)


class Full:
    """One place for every byte."""

    __slots__ = ("prefix", "value", "kids")

    def __init__(self, middle: Indexed):
        self.prefix, self.value = middle.prefix, middle.value
        self.kids = [None if at == 255 else middle.kids[at] for at in middle.places]

    def find(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def children(self) -> Iterator:
        return (kid for kid in self.kids if kid is not None)


def _shared(prefix: bytes, key: bytes, at: int) -> int:
    if key.startswith(prefix, at):
        return len(prefix)
    n = 0
    for a, b in zip(prefix, memoryview(key)[at:]):
        if a != b:
            break
        n += 1
    return n


class Tree:
    """Distinct byte strings, each with a number of at least 0. A key may be the beginning of another."""

    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value: int) -> None:
        if self.root is None:
            self.root = Sparse(key, value)
            return
        above, via, node, at = None, 0, self.root, 0
        while True:
            n = _shared(node.prefix, key, at)
            if n < len(node.prefix):
                split = Sparse(node.prefix[:n])
                byte, node.prefix = node.prefix[n], node.prefix[n + 1 :]
                split.put(byte, node)
                self._replace(above, via, split)
                node = split
            at += n
            if at == len(key):
                node.value = value
                return
            kid = node.find(key[at])
            if kid is None:
                grown = node.put(key[at], Sparse(key[at + 1 :], value))
                if grown is not node:
                    self._replace(above, via, grown)
                return
            above, via, node, at = node, key[at], kid, at + 1

    def _replace(self, above, via: int, node) -> None:
        if above is None:
            self.root = node
        else:
            above.put(via, node)

    def walk(self) -> Iterator[tuple[int, int]]:
        """Depth first, in the order of the keys: (bytes down to the end of a node's path, its value or -1) on the way in,
        (bytes above its path, -2) on the way out."""
        if self.root is None:
            return
        bottom = len(self.root.prefix)
        yield bottom, self.root.value
        stack = [(0, bottom, self.root.children())]
        while stack:
            top, bottom, kids = stack[-1]
            kid = next(kids, None)
            if kid is None:
                yield top, -2
                stack.pop()
            else:
                end = bottom + 1 + len(kid.prefix)
                yield end, kid.value
                stack.append((bottom, end, kid.children()))
