"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_counts(text):
    w = words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
            "base_failed": n < 10 or 100 * len(repeated) > 20 * n}


def quality(rows, max_docs=20, min_left=10, min_left_share=0.2):
    """rows: (doc_id, text, source) -> list of dicts in the same order."""
    norm = [[" ".join(words(x)).lower() for x in (t or "").split("\n") if words(x)] for _, t, _ in rows]
    docs, sigs = defaultdict(set), defaultdict(set)
    for (i, t, h), ls in zip(rows, norm):
        sig = "\n".join(ls)
        for x in ls:
            docs[h, x].add((i, t))
            sigs[h, x].add(sig)
    bad = {k for k in sigs if len(sigs[k]) > max_docs}
    out = []
    for (i, t, h), ls in zip(rows, norm):
        b = base_counts(t)
        lost = sum(len(x.split(" ")) for x in ls if (h, x) in bad)
        left = b["n_words"] - lost
        depleted = lost > 0 and (left < min_left or left < min_left_share * b["n_words"])
        out.append({"doc_id": i, **b, "kept": not b["base_failed"] and not depleted})
    return out


def fingerprint(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = words(low)
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def group(fps, bits=3):
    """fps: {node: fingerprint} -> {node: smallest node reachable}."""
    nodes = sorted(fps)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def letters(text):
    return [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]


def contained(docs, items, threshold=0.8):
    """docs, items: (id, text) -> {(doc, item): (item shingles, found)}."""
    out = {}
    for k, t in items:
        w = letters(t)
        n = min(5, len(w))
        if not n:
            continue
        want = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        for d, text in docs:
            v = letters(text)
            found = len(want & {tuple(v[i:i + n]) for i in range(len(v) - n + 1)})
            if found >= threshold * len(want) - 1e-9:
                out[d, k] = max(out.get((d, k), (0, 0)), (len(want), found))
    return out
