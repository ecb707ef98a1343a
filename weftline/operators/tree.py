"""Discovery tree of each site: who led to whom, pruned to what was fetched, capped for display."""

from __future__ import annotations

from collections import Counter, deque
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "site string, idx int, label string, parent int, state string, host string, truncated boolean, kept int"


def build(items: list[tuple[str, str | None, str]], most_children: int = 40, most_nodes: int = 3000) -> tuple[list[dict], bool, int]:
    """(nodes, truncated, URLs kept) of (url, discovered_from, state): breadth first, larger subtrees first, then by URL."""
    state = {u: s for u, _, s in items}
    kids: dict[str | None, list[str]] = {}
    for u, p in {u: p for u, p, _ in items}.items():
        kids.setdefault(p if p in state else None, []).append(u)
    hosts = Counter(urlsplit(u).netloc for u in state)
    home = next(iter(hosts.most_common(1)), ("", 0))[0]
    order, at = list(kids.get(None, [])), 0
    while at < len(order):
        order += kids.get(order[at], [])
        at += 1
    size: dict[str, int] = {}
    for u in reversed(order):
        below = sum(size.get(c, 0) for c in kids.get(u, []))
        if below or state[u] == "done":
            size[u] = below + 1
    ranked = lambda u: sorted((c for c in kids.get(u, []) if c in size), key=lambda c: (-size[c], c))
    if not size:
        return [], False, 0
    nodes, cut = [{"label": "", "parent": -1, "state": "root", "host": None}], False
    line = deque((c, 0) for c in ranked(None))
    while line:
        if len(nodes) >= most_nodes:
            cut = True
            break
        u, parent = line.popleft()
        x = urlsplit(u)
        nodes.append({"label": (x.path or "/") + (f"?{x.query}" if x.query else ""), "parent": parent, "state": state[u], "host": x.netloc if x.netloc != home else None})
        me, mine = len(nodes) - 1, ranked(u)
        line.extend((c, me) for c in mine[:most_children])
        if len(mine) > most_children:
            if len(nodes) < most_nodes:
                nodes.append({"label": f"+{len(mine) - most_children} more", "parent": me, "state": "more", "host": None})
            else:
                cut = True
    return nodes, cut, len(size)


def discovery_trees(queue: DataFrame, most_children: int = 40, most_nodes: int = 3000) -> DataFrame:
    """Nodes of every site's tree. A site's URLs meet in one task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("url")
        parents = [None if pd.isna(p) else p for p in pdf["discovered_from"]]
        nodes, cut, kept = build(list(zip(pdf["url"], parents, pdf["work_state"])), most_children, most_nodes)
        rows = [{"site": pdf["site"].iloc[0], "idx": i, **n, "truncated": cut, "kept": kept} for i, n in enumerate(nodes)]
        return pd.DataFrame(rows, columns=["site", "idx", "label", "parent", "state", "host", "truncated", "kept"])

    return queue.select("site", "url", "discovered_from", "work_state").groupBy("site").applyInPandas(run, SCHEMA)
