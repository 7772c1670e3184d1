"""Signature trees: which pairs of token sets may overlap enough, and which do.

A set's signature has a bit for every token's hash. A node holds the bits that
any set below has (OR), those that all have (AND) and the range of sizes. A bit
that all sets of one node have and none of the other stands for a token that is
not shared, which bounds the overlap of every pair below. Two trees are walked
together from their roots, and pairs of nodes that cannot reach the threshold are
left out, as are nodes whose sets are one component already.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF = 16
FAN = 4
# A signature has two to four bits for a token; one of 2^k bits folds to any smaller power.
LEAST_BITS, MOST_BITS = 9, 20


def signature(tokens: np.ndarray) -> bytes:
    exponent = min(max(int(2 * len(tokens) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    bits = np.zeros(1 << exponent, np.uint8)
    bits[(tokens & np.uint64((1 << exponent) - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _folded(signatures: list[bytes], size: int) -> np.ndarray:
    """Signatures of one length as rows of 64-bit words, folded to ``size`` bytes."""
    rows = np.frombuffer(b"".join(signatures), np.uint64).reshape(len(signatures), -1)
    while rows.shape[1] * 8 > size:
        half = rows.shape[1] // 2
        rows = rows[:, :half] | rows[:, half:]
    return rows


class Components:
    """Union-find over the sets of one task."""

    def __init__(self, labels: np.ndarray):
        # Sets with the same label start together.
        _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
        self.parent = first[inverse].tolist()

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.parent))], np.int64)


class Node:
    __slots__ = ("all", "any", "bits", "children", "least", "members", "most", "sizes")

    def __init__(self, members, bits, sizes, children=()):
        self.members, self.children = members, children
        if children:
            self.any = np.bitwise_or.reduce([c.any for c in children])
            self.all = np.bitwise_and.reduce([c.all for c in children])
            self.least, self.most = children[0].least, children[-1].most
        else:
            self.bits, self.sizes = bits, sizes
            self.any, self.all = np.bitwise_or.reduce(bits), np.bitwise_and.reduce(bits)
            self.least, self.most = int(sizes[0]), int(sizes[-1])


def build(bits: np.ndarray, sizes: np.ndarray, members: np.ndarray) -> Node:
    """A tree over ``members`` with their signatures and sizes, bulk-loaded by size."""
    order = np.argsort(sizes, kind="stable")
    level = [
        Node(members[own], bits[own], sizes[own])
        for own in (order[at : at + LEAF] for at in range(0, len(order), LEAF))
    ]
    while len(level) > 1:
        groups = [tuple(level[at : at + FAN]) for at in range(0, len(level), FAN)]
        level = [Node(np.concatenate([c.members for c in g]), None, None, g) for g in groups]
    return level[0]


def link(
    signatures: list[bytes],
    sizes: np.ndarray,
    left: np.ndarray,
    right: np.ndarray,
    part: int,
    whole: int,
    known: Components,
    linked: Callable[[int, int], bool],
) -> None:
    """Unite in ``known`` all sets of ``left`` and ``right`` with similarity part/whole or more.

    ``left`` and ``right`` are the same sets or have none in common. ``linked``
    decides on a pair that the signatures allow; it is asked only while the two
    are in different components. Sets of one length of signature are one tree;
    where two lengths meet, the longer signatures are folded.
    """
    lengths = np.array([len(x) for x in signatures])
    same = left is right

    def tree(own: np.ndarray, size: int) -> Node:
        return build(_folded([signatures[i] for i in own], size), sizes[own], own)

    kinds = [{int(n): some[lengths[some] == n] for n in np.unique(lengths[some])} for some in (left, right)]
    for n, own in kinds[0].items():
        for m, other in kinds[1].items():
            if same and m < n:
                continue
            if part * sizes[own].min() > whole * sizes[other].max():
                continue
            if part * sizes[other].min() > whole * sizes[own].max():
                continue
            a = tree(own, min(n, m))
            b = a if same and n == m else tree(other, min(n, m))
            _join(a, b, part, whole, known, linked)


def _join(a: Node, b: Node, part: int, whole: int, known: Components, linked) -> None:
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if x is not y:
            lost_x = int(np.bitwise_count(x.all & ~y.any).sum())
            lost_y = int(np.bitwise_count(y.all & ~x.any).sum())
            if (
                (x.most - lost_x) * (whole + part) < part * (x.most + y.least)
                or (y.most - lost_y) * (whole + part) < part * (y.most + x.least)
                or part * x.least > whole * y.most
                or part * y.least > whole * x.most
            ):
                continue
        root = known.find(int(x.members[0]))
        if all(known.find(int(m)) == root for m in x.members) and all(
            known.find(int(m)) == root for m in y.members
        ):
            continue
        if not x.children and not y.children:
            _leaves(x, y, part, whole, known, linked)
        elif x is y:
            kids = x.children
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
        elif x.children and (not y.children or len(x.members) >= len(y.members)):
            stack += [(c, y) for c in x.children]
        else:
            stack += [(x, c) for c in y.children]


def _leaves(x: Node, y: Node, part: int, whole: int, known: Components, linked) -> None:
    left, right = x.bits[:, None, :], y.bits[None, :, :]
    n, m = x.sizes[:, None], y.sizes[None, :]
    shared = np.minimum(
        n - np.bitwise_count(left & ~right).sum(-1, dtype=np.int64),
        m - np.bitwise_count(right & ~left).sum(-1, dtype=np.int64),
    )
    able = shared * (whole + part) >= part * (n + m)
    if x is y:
        able &= np.triu(np.ones(able.shape, bool), 1)
    for i, j in zip(*np.nonzero(able), strict=True):
        p, q = int(x.members[i]), int(y.members[j])
        if known.find(p) != known.find(q) and linked(p, q):
            known.union(p, q)
