"""Plain Python versions of the query contracts, for small fixtures."""

import hashlib
import re
from collections import defaultdict

import numpy as np


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()


class Groups:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def luhn(digits):
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def pii(text):
    """(n_email, n_ip, n_card, n_phone, base_sha256)"""

    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         lambda s: all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    found = [[(k, m.start(), m.end()) for m in re.finditer(rx, text) if ok(m.group())] for k, rx, ok in rules]
    return (*map(len, found), sha(f"{k}:{a}:{b}" for f in found for k, a, b in f))


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)"""

    text = text or ""
    spans = []
    rx = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), 0, m.end()) for m in re.finditer(rx, text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    kinds = ("assign", "access", "hex")
    return (*(sum(s[1] == k for s in spans) for k in range(3)),
            sha(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans)))


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near(rows):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows with distinct ids."""

    sets = {d: shingles(t) for d, t in rows}
    groups = Groups(sets)
    at, common = defaultdict(list), defaultdict(int)
    for d in sorted(sets):
        for s in sets[d]:
            for e in at[s]:
                common[e, d] += 1
            at[s].append(d)
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            groups.link(a, b)
    return {d: (len(s), groups.find(d)) for d, s in sets.items()}


def vectors(rows):
    """{vec_id: (n_links, component_id)} of (vec_id, vector) rows with distinct ids."""

    def good(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in rows if good(v)}
    groups, n = Groups([i for i, _ in rows]), defaultdict(int)
    for a in units:
        for b in units:
            if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95:
                groups.link(a, b)
                n[a] += 1
                n[b] += 1
    return {i: (n[i], groups.find(i)) for i, _ in rows}


def contamination(docs, items, window=10):
    """{doc_id: (n_words, n_hit, items)} of (doc_id, text) and (item_id, text) rows."""

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    wins = set()
    for name, text in items:
        w = words(text)
        k = min(window, len(w))
        wins |= {(name, tuple(w[i : i + k])) for i in range(len(w) - k + 1) if w}
    out = {}
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for name, win in wins:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    names.add(str(name))
        out[d] = (len(w), len(hit), sorted(names))
    return out


def trie(convs, group=5, most=9, branching=True):
    """Nodes of the rebuilt conversations by (conv_id, depth); ``convs`` are (conv_id, turn, role, text) without ties."""

    import hashlib
    import zlib

    own = {}
    for c, turn, role, text in convs:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most if branching else 0
        paths[c] = tuple(own.get(c - c % group, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def under(node):
        todo, leaves, saved = [node], 0, 0
        while todo:
            x = todo.pop()
            leaves += x not in kids
            saved += (len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0
            todo += kids.get(x, [])
        return leaves, saved

    out = {}
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(node))
        out[min(cs), len(node)] = (min(members[node[:-1]]) if node else None, len(cs), len(kids.get(node, [])), *under(node),
                                   hashlib.sha256(ends.encode()).hexdigest())
    return out


def resampled(docs, target, share=10, least=20, buckets=10_000, longest=1):
    """doc_id -> (n_features, weight, score, rank) of documents with distinct ids."""

    import hashlib
    import math
    import re
    import zlib
    from collections import Counter

    def feats(text):
        low = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    s = Counter(b for _, text in docs for b in feats(text)[1])
    t = Counter(b for text in target for b in feats(text)[1])
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))

    rows = []
    for doc, text in docs:
        words, found = feats(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    ranks = {r[0]: i + 1 for i, r in enumerate(able[: share * len(able) // 100])}
    return {r[0]: (*r[2:], ranks.get(r[0])) for r in rows}
