"""Minimum cuts of small labelling graphs."""

from __future__ import annotations

from collections import deque

Edges = dict[tuple[int, int], float]


def _flow_labels(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True on the source side. gain > 0: capacity from the source, < 0: to the sink."""
    n = len(gain)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, g in enumerate(gain):
        if g > 0:
            connect(source, k, g, 0.0)
        elif g < 0:
            connect(k, sink, -g, 0.0)
    for a, b, w in edges:
        connect(a, b, w, w)
    while True:
        # Shortest augmenting path.
        came = {source: -1}
        queue = deque([source])
        while queue and sink not in came:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and to[e] not in came:
                    came[to[e]] = e
                    queue.append(to[e])
        if sink not in came:
            return [k in came for k in range(n)]
        path, at = [], sink
        while at != source:
            path.append(came[at])
            at = to[came[at] ^ 1]
        most = min(room[e] for e in path)
        for e in path:
            room[e] -= most
            room[e ^ 1] += most


def cut(gain: list[float], edges: Edges) -> list[bool]:
    """The labelling of least cost: a node pays |gain| against its sign, an edge its weight when cut.

    A node whose gain is at least all its edges keeps its sign in some least cut; it is
    settled first and its edges pass to its neighbours. Max-flow labels the rest.
    """
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in gain]
    for (a, b), w in edges.items():
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * len(gain)
    queue = list(range(len(gain)))
    while queue:
        k = queue.pop()
        if label[k] is None and abs(gain[k]) >= sum(near[k].values()):
            label[k] = gain[k] > 0
            for other, w in near[k].items():
                gain[other] += w if label[k] else -w
                del near[other][k]
                queue.append(other)
            near[k] = {}
    rest = [k for k, x in enumerate(label) if x is None]
    if rest:
        place = {k: i for i, k in enumerate(rest)}
        some = [(place[a], place[b], w) for a in rest for b, w in near[a].items() if a < b]
        for k, side in zip(rest, _flow_labels([gain[k] for k in rest], some), strict=True):
            label[k] = side
    return [bool(x) for x in label]
