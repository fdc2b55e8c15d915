"""Minimum cuts of small graphs."""

from __future__ import annotations

from collections import deque


def content_side(gains: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """For each node whether it is on the source's side of a minimum cut.

    A positive gain is what the cut loses if the node goes to the sink's side, a
    negative one if it stays on the source's; a link (a, b, cost) is lost where its
    ends part. Flow is pushed along shortest paths from gaining to losing nodes
    until none is left; nodes that can still be reached are the source's.
    """
    n = len(gains)
    spare = [max(0, g) for g in gains]
    room = [max(0, -g) for g in gains]
    to: list[int] = []
    left: list[int] = []
    at: list[list[int]] = [[] for _ in range(n)]
    for a, b, cost in links:
        if a != b and cost > 0:
            at[a].append(len(to))
            at[b].append(len(to) + 1)
            to += [b, a]
            left += [cost, cost]
    while True:
        level = [-1] * n
        queue = deque(v for v in range(n) if spare[v])
        for v in queue:
            level[v] = 0
        meets = False
        while queue:
            v = queue.popleft()
            meets = meets or room[v] > 0
            for e in at[v]:
                if left[e] and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if not meets:
            return [x >= 0 for x in level]
        turn = [0] * n
        for start in range(n):
            while spare[start] and level[start] == 0:
                path: list[int] = []
                v = start
                while True:
                    if room[v]:
                        flow = min([spare[start], room[v], *[left[e] for e in path]])
                        spare[start] -= flow
                        room[v] -= flow
                        for e in path:
                            left[e] -= flow
                            left[e ^ 1] += flow
                        break
                    edges = at[v]
                    while turn[v] < len(edges) and not (left[edges[turn[v]]] and level[to[edges[turn[v]]]] == level[v] + 1):
                        turn[v] += 1
                    if turn[v] < len(edges):
                        path.append(edges[turn[v]])
                        v = to[path[-1]]
                    elif path:
                        level[v] = -2  # leads nowhere in this round
                        v = to[path.pop() ^ 1]
                        turn[v] += 1
                    else:
                        break
                if not path and not room[start] and turn[start] >= len(at[start]):
                    break
