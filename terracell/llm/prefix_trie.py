"""A prefix tree over globally ordered sets, probed for all sets of a Jaccard similarity."""

from __future__ import annotations

import numpy as np


def least_overlap(n: int, m: int, percent: int) -> int:
    """The smallest overlap at which sets of n and m members link: 100 * overlap >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class _Node:
    """edge: ranks from the parent. ended: sets that end here. same: a set whose component all sets below share, or -1."""

    __slots__ = ("edge", "below", "ended", "least", "longest", "same")

    def __init__(self, edge, size: int, length: int, member: int):
        self.edge, self.below, self.ended = edge, {}, []
        self.least, self.longest, self.same = size, length, member


class PrefixTree:
    """Sets are inserted by ascending size; each is first probed against those before it.

    A path is a set's members in the global order, those that most sets share
    first, so sets share what they have in common. A probe carries the overlap
    with the path so far and goes below a node only if what is left of both
    sides can still reach the overlap that the smallest set below needs. A
    subtree whose sets are all in the probing set's own component is skipped:
    a link into it would add nothing.
    """

    def __init__(self, members: int, count: int, percent: int):
        self.percent, self.union = percent, Union(count)
        self.root = _Node(np.zeros(0, dtype=np.int64), 1 << 60, 0, -1)
        self.inside = np.zeros(members, dtype=bool)
        self.links: list[tuple[int, int]] = []

    def _same(self, node: _Node) -> int:
        find = self.union.find
        if node.same >= 0:
            return find(node.same)
        roots = {find(i) for i in node.ended[:8]} if len(node.ended) <= 8 else {find(i) for i in node.ended}
        for child in node.below.values():
            if child.same < 0 or len(roots) > 1:
                return -1
            roots.add(find(child.same))
        if len(roots) == 1:
            node.same = roots.pop()
            return node.same
        return -1

    def probe(self, x: int, ranks: np.ndarray, size: int, sizes: list[int]) -> None:
        """Links x with at least one set of every component it links to, among those inserted."""
        percent, union, inside = self.percent, self.union, self.inside
        inside[ranks] = True
        total = len(ranks)
        stack = [(self.root, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            if self._same(node) == union.find(x) and node is not self.root:
                continue
            edge = node.edge
            if len(edge):
                overlap += int(np.count_nonzero(inside[edge]))
                depth += len(edge)
                left = total - int(np.searchsorted(ranks, edge[-1], side="right"))
            else:
                left = total
            if overlap + min(left, node.longest - depth) < least_overlap(size, node.least, percent):
                continue
            for y in node.ended:
                if 100 * overlap >= percent * (size + sizes[y] - overlap) and union.join(x, y):
                    self.links.append((x, y))
            later = []
            for first, child in node.below.items():
                (stack if not inside[first] else later).append((child, overlap, depth))
            stack.extend(later)
        inside[ranks] = False

    def insert(self, x: int, ranks: np.ndarray, size: int) -> None:
        node, at = self.root, 0
        while True:
            node.least, node.longest = min(node.least, size), max(node.longest, len(ranks))
            if node.same >= 0 and self.union.find(node.same) != self.union.find(x):
                node.same = -1
            if at == len(ranks):
                node.ended.append(x)
                return
            child = node.below.get(int(ranks[at]))
            if child is None:
                leaf = _Node(ranks[at:], size, len(ranks), x)
                leaf.ended.append(x)
                node.below[int(ranks[at])] = leaf
                return
            edge, rest = child.edge, ranks[at : at + len(child.edge)]
            differs = np.flatnonzero(edge[: len(rest)] != rest)
            common = int(differs[0]) if len(differs) else len(rest)
            if common < len(edge):
                middle = _Node(edge[:common], child.least, child.longest, child.same)
                child.edge = edge[common:]
                middle.below[int(child.edge[0])] = child
                node.below[int(edge[0])] = middle
                child = middle
            node, at = child, at + common


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that span the components of distinct sets under Jaccard similarity >= percent / 100.

    Members that one set alone has never overlap, so they only count for
    sizes, and a set with too few shared members has no partner: such sets go,
    and what they alone shared goes with them, until nothing changes.
    """
    alive = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    member, token = np.repeat(alive, sizes), np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    need = -(-percent * sizes // 100)
    while len(token):
        _, rank, count = np.unique(token, return_inverse=True, return_counts=True)
        shared = count[rank] > 1
        member, token, rank = member[shared], token[shared], rank[shared]
        enough = np.bincount(member, minlength=len(sets)) >= need
        stays = enough[member]
        if stays.all():
            break
        member, token = member[stays], token[stays]
    if not len(token):
        return []
    # The global order: members by how many sets have them, then by value.
    values, rank, count = np.unique(token, return_inverse=True, return_counts=True)
    order = np.empty(len(values), dtype=np.int64)
    order[np.lexsort((values, -count))] = np.arange(len(values))
    rank = order[rank]
    by = np.lexsort((rank, member))
    member, rank = member[by], rank[by]
    present, starts = np.unique(member, return_index=True)
    paths = dict(zip(present.tolist(), np.split(rank, starts[1:]), strict=True))
    listed = sizes.tolist()
    tree = PrefixTree(len(values), len(sets), percent)
    for x in sorted(paths, key=lambda i: (listed[i], i)):
        tree.probe(x, paths[x], listed[x], listed)
        tree.insert(x, paths[x], listed[x])
    return tree.links
