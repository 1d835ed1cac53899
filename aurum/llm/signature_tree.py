"""Signature trees over token bitmaps, and their dual traversal for a Jaccard threshold of three quarters.

A leaf is one set: its size and a bitmap in which every token sets the bit of its hash.  An inner node holds the
OR-combined bitmaps of its leaves, the range of their sizes and the most tokens that any of them loses to shared bits
(``excess``).  Two sets can have at most as many tokens in common as their bitmaps have common bits, plus the smaller
excess; the same holds for all pairs below two nodes.  Bitmaps have a power-of-two width of at least five times the
size, so that few tokens share a bit, and are folded to the narrower one before they are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

FANOUT = 8


def bitmap(tokens: np.ndarray) -> bytes:
    """The bitmap of distinct 64-bit hashes, little-endian."""
    width = max(64, 1 << (5 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: int, width: int, narrow: int) -> int:
    while width > narrow:
        width >>= 1
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


@dataclass(slots=True, eq=False)
class Node:
    """A node with the range of sizes below it; leaves have no children and carry their set's id and class."""

    bits: int
    width: int
    low: int
    high: int
    excess: int
    children: list[Node]
    leaves: list[Node]
    id: int = 0
    part: int = 0


def leaf(key: int, size: int, packed: bytes, part: int = 0) -> Node:
    bits = int.from_bytes(packed, "little")
    node = Node(bits, 8 * len(packed), size, size, size - bits.bit_count(), [], [], key, part)
    node.leaves.append(node)
    return node


def combine(nodes: list[Node]) -> Node:
    width = min(n.width for n in nodes)
    bits = 0
    for n in nodes:
        bits |= fold(n.bits, n.width, width)
    leaves = [x for n in nodes for x in n.leaves]
    excess = max(x.low - fold(x.bits, x.width, width).bit_count() for x in leaves)
    return Node(bits, width, min(n.low for n in nodes), max(n.high for n in nodes), excess, nodes, leaves)


def build(leaves: list[Node], fanout: int = FANOUT) -> Node:
    level = sorted(leaves, key=lambda n: (n.part, n.low, n.id))
    while len(level) > 1:
        level = [combine(level[i : i + fanout]) if len(level[i : i + fanout]) > 1 else level[i]
                 for i in range(0, len(level), fanout)]
    return level[0]


def may_link(x: Node, y: Node) -> bool:
    """False only if no set below ``x`` and no set below ``y`` have a Jaccard similarity of at least 3/4."""
    if 4 * x.high < 3 * y.low or 4 * y.high < 3 * x.low:
        return False
    if x.width == y.width:
        common, excess = x.bits & y.bits, min(x.excess, y.excess)
    elif x.width < y.width:
        common, excess = x.bits & fold(y.bits, y.width, x.width), x.excess
    else:
        common, excess = fold(x.bits, x.width, y.width) & y.bits, y.excess
    overlap = min(common.bit_count() + excess, x.high, y.high)
    return 7 * overlap >= 3 * (x.low + y.low)


def candidates(x: Node, y: Node, joined: Callable[[Node, Node], bool]) -> Iterator[tuple[Node, Node]]:
    """Leaf pairs that may link, one of ``x`` and one of ``y`` (which may be the same node).

    ``joined`` says of two leaves that they need no test; it may change while the pairs are drawn.
    """
    stack = [(x, y)]
    while stack:
        a, b = stack.pop()
        if a is b:
            kids = a.children
            stack += [(p, q) for i, p in enumerate(kids) for q in kids[i:]]
        elif may_link(a, b):
            if not a.children and not b.children:
                if not joined(a, b):
                    yield a, b
            elif a.children and (not b.children or len(a.leaves) >= len(b.leaves)):
                stack += [(p, b) for p in a.children]
            else:
                stack += [(a, q) for q in b.children]
