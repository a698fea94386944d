"""Adaptive radix trees: inner nodes that grow with their children, and compressed paths."""

from os.path import commonprefix


class Sorted:
    """Up to `room` children beside their sorted bytes."""

    __slots__ = ("bytes", "nodes", "room")

    def __init__(self, room: int):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node) -> bool:
        """False if there is no room."""
        at = self.bytes.find(byte)
        if at >= 0:
            self.nodes[at] = node
        elif len(self.nodes) == self.room:
            return False
        else:
            at = sum(b < byte for b in self.bytes)
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)
        return True

    def items(self):
        return zip(self.bytes, self.nodes, strict=True)


class Indexed:
    """Up to 48 children, found through a table of 256 one-byte places."""

    __slots__ = ("nodes", "place")

    def __init__(self):
        self.place, self.nodes = bytearray(256), []

    def get(self, byte: int):
        return self.nodes[self.place[byte] - 1] if self.place[byte] else None

    def put(self, byte: int, node) -> bool:
        if self.place[byte]:
            self.nodes[self.place[byte] - 1] = node
            return True
        if len(self.nodes) == 48:
            return False
        self.nodes.append(node)
        self.place[byte] = len(self.nodes)
        return True

    def items(self):
        return ((b, self.nodes[p - 1]) for b, p in enumerate(self.place) if p)


class Full:
    """A place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> bool:
        self.nodes[byte] = node
        return True

    def items(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


LAYOUTS = (lambda: Sorted(4), lambda: Sorted(16), Indexed, Full)


class Node:
    """path: the bytes that lead here from the node above; row: what is kept for the key that ends here."""

    __slots__ = ("children", "kind", "path", "row")

    def __init__(self, path: bytes, row=None):
        self.path, self.row, self.kind, self.children = path, row, -1, None

    def child(self, byte: int):
        return self.children.get(byte) if self.children else None

    def put(self, byte: int, node) -> None:
        while self.children is None or not self.children.put(byte, node):
            before, self.kind = self.children, self.kind + 1
            self.children = LAYOUTS[self.kind]()
            for b, n in before.items() if before else ():
                self.children.put(b, n)

    def items(self):
        """Children by ascending byte."""
        return self.children.items() if self.children else ()


def insert(root: Node, key: bytes, row) -> None:
    """Keep `row` for a key; of equal keys the last."""
    node, at = root, 0
    while at < len(key):
        child = node.child(key[at])
        if child is None:
            node.put(key[at], Node(key[at:], row))
            return
        if not key.startswith(child.path, at):
            same = len(commonprefix((child.path, key[at : at + len(child.path)])))
            upper = Node(child.path[:same])
            node.put(key[at], upper)
            child.path = child.path[same:]
            upper.put(child.path[0], child)
            child = upper
        node, at = child, at + len(child.path)
    node.row = row


def walk(root: Node):
    """(path, bytes above the node, row) of all nodes, each before its children and these by ascending byte.

    `path` is one buffer that holds the whole key down to the node.
    """
    path, left = bytearray(), [(root, 0)]
    while left:
        node, above = left.pop()
        path[above:] = node.path
        yield path, above, node.row
        left += [(child, len(path)) for _, child in reversed(list(node.items()))]
