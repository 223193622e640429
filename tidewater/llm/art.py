"""Adaptive radix tree over byte keys.

A node keeps its outgoing bytes in the smallest of four layouts that holds them
(4 and 16: parallel lists, 48: an index of 256 bytes into a list, 256: a plain
array) and grows to the next one as it fills up. A chain of nodes with one child
each is one node with a compressed prefix. Keys may be prefixes of other keys: a
key that ends at a node leaves its value there.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import Any

#: Children that the layouts hold.
LAYOUTS = (4, 16, 48, 256)


class Node:
    """One node: the compressed ``prefix`` that leads into it, its children in the
    layout ``layout`` and the value of the key that ends here (None: none)."""

    __slots__ = ("bytes", "children", "layout", "prefix", "value")

    def __init__(self, prefix: bytes, value: Any = None):
        self.prefix = prefix
        self.value = value
        self.layout = 4
        self.bytes: Any = []
        self.children: list = []

    def child(self, b: int) -> Node | None:
        if self.layout <= 16:
            at = bisect_left(self.bytes, b)
            return self.children[at] if at < len(self.bytes) and self.bytes[at] == b else None
        if self.layout == 48:
            at = self.bytes[b]
            return self.children[at - 1] if at else None
        return self.children[b]

    def put(self, b: int, node: Node) -> None:
        """Set the child of byte ``b``, in the next layout if this one is full."""
        if self.layout <= 16:
            at = bisect_left(self.bytes, b)
            if at < len(self.bytes) and self.bytes[at] == b:
                self.children[at] = node
                return
            if len(self.bytes) < self.layout:
                insort(self.bytes, b)
                self.children.insert(at, node)
                return
            self._grow()
            self.put(b, node)
        elif self.layout == 48:
            if self.bytes[b]:
                self.children[self.bytes[b] - 1] = node
            elif len(self.children) < 48:
                self.children.append(node)
                self.bytes[b] = len(self.children)
            else:
                self._grow()
                self.put(b, node)
        else:
            self.children[b] = node

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray(256)
            for at, b in enumerate(self.bytes):
                index[b] = at + 1
            self.bytes, self.layout = index, 48
        else:
            self.children = [self.children[at - 1] if at else None for at in self.bytes]
            self.bytes, self.layout = None, 256

    def ordered(self) -> Iterator[tuple[int, Node]]:
        """Children with their bytes, in byte order."""
        if self.layout <= 16:
            yield from zip(self.bytes, self.children, strict=True)
        elif self.layout == 48:
            yield from ((b, self.children[at - 1]) for b, at in enumerate(self.bytes) if at)
        else:
            yield from ((b, c) for b, c in enumerate(self.children) if c is not None)


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # the first low bytes agree, the first high ones do not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Tree:
    """Keys and values; a second value under a key replaces the first."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value: Any) -> None:
        node, at, up = self.root, 0, None
        while True:
            n = _shared(node.prefix, key[at : at + len(node.prefix)])
            if n < len(node.prefix):  # the key leaves inside the compressed prefix: split it
                top = Node(node.prefix[:n])
                low = node.prefix[n]
                node.prefix = node.prefix[n + 1 :]
                top.put(low, node)
                if up is None:
                    self.root = top
                else:
                    up.put(key[at - 1], top)
                node = top
            at += n
            if at == len(key):
                node.value = value
                return
            below = node.child(key[at])
            if below is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            up, node, at = node, below, at + 1

    def walk(self) -> Iterator[tuple[int, bytes, Node]]:
        """Nodes in key order, parents first: the byte depth at which the node's label
        begins, the label (the byte that leads here and the prefix), the node."""
        stack = [(0, self.root.prefix, self.root)]
        while stack:
            begin, label, node = stack.pop()
            yield begin, label, node
            end = begin + len(label)
            stack.extend(reversed([(end, bytes((b,)) + c.prefix, c) for b, c in node.ordered()]))
