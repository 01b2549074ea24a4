"""Plain versions of the conversation trie, by sequences as dictionary keys."""

from __future__ import annotations

import hashlib
import zlib


def rebuilt(rows) -> dict[int, list]:
    """conv_id -> its rebuilt turns; ``rows`` are (conv_id, turn, role, text)."""
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16]
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        lead = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(lead, [])[:h] + turns[h:]
    return out


def trie(rows) -> set[tuple]:
    seqs = rebuilt(rows)
    nodes: dict[tuple, list[int]] = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids: dict[tuple, list[tuple]] = {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    total: dict[tuple, tuple[int, int]] = {}
    for k in sorted(nodes, key=len, reverse=True):
        below = [total[x] for x in kids.get(k, [])]
        own = (len(nodes[k]) - 1) * len(k[-1][1]) if k else 0
        total[k] = (sum(b[0] for b in below) if below else 1, own + sum(b[1] for b in below))
    out = set()
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(k))
        out.add((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(kids.get(k, [])),
                 *total[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out
