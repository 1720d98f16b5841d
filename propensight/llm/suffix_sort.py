"""Deep-shallow sorting: multikey quicksort to a shallow depth, blind tries below it."""

from __future__ import annotations

STEP = 8  # bytes compared as one character by the quicksort
SHALLOW = 24
SMALL = 2  # groups that are compared directly


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Orders strings that share a long prefix. Inner nodes hold only the depth at which their children part."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None  # a leaf is a list of indexes, an inner node a pair of depth and children

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):  # blind: only the bytes at branches are looked at
            node = node[1].get(s[node[0]] if node[0] < len(s) else -1) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        depth = common(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            return
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][s[node[0]] if node[0] < len(s) else -1]
        mine = s[depth] if depth < len(s) else -1
        if isinstance(node, tuple) and node[0] == depth:
            node[1][mine] = [i]
            return
        theirs = other[depth] if depth < len(other) else -1
        split = (depth, {mine: [i], theirs: node})
        if above is None:
            self.root = split
        else:
            above[1][s[above[0]] if above[0] < len(s) else -1] = split

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def deep_shallow(strings: list[bytes], depth: int = 0) -> list[int]:
    """Indexes in the order of ``strings``, which share their first ``depth`` bytes."""
    out: list[int] = []
    limit = depth + SHALLOW
    stack = [(list(range(len(strings))), depth)]
    while stack:
        group, at = stack.pop()
        if len(group) <= SMALL:
            out.extend(sorted(group, key=strings.__getitem__))
            continue
        if at >= limit:
            trie = BlindTrie(strings)
            for i in group:
                trie.add(i)
            out.extend(trie.ordered())
            continue
        keys = [strings[i][at:at + STEP] for i in group]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less = [i for i, k in zip(group, keys, strict=True) if k < pivot]
        same = [i for i, k in zip(group, keys, strict=True) if k == pivot]
        more = [i for i, k in zip(group, keys, strict=True) if k > pivot]
        if more:
            stack.append((more, at))
        if len(pivot) < STEP:  # these strings end here
            stack.append((same, limit))
        else:
            stack.append((same, at + STEP))
        if less:
            stack.append((less, at))
    return out
