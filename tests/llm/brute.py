"""The contracts, computed the plain way."""

import collections
import hashlib
import math
import re
import zlib

SPACE = r"[\x20\x09-\x0D]+"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def components(rows, size=5):
    """doc_id: (n_shingles, component_id)."""
    sets = {}
    for i, t in rows:
        w = words((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    found = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, s in sets.items():
            for b, t in sets.items():
                if s and t and 100 * len(s & t) >= 75 * len(s | t) and found[b] < found[a]:
                    found[a], changed = found[b], True
    return {i: (len(sets[i]), found[i]) for i in sets}


def removed(rows, span=50):
    """doc_id: (n_bytes, n_removed, n_spans, kept_sha256)."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - span + 1):
            s = b[p : p + span]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - span + 1):
            if first[b[p : p + span]] < i:
                gone[p : p + span] = b"\1" * span
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    hit = set()
    for k in range(len(w) - 4):
        if windows[tuple(w[k : k + 5])] > 1:
            hit.update(range(k, k + 5))
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(hit)


def lines_removed(rows, run=3):
    """doc_id: (n_lines, n_removed, n_runs, kept)."""
    worded = {i: [(k, x) for k, x in enumerate((t or "").split("\n")) if words(x)] for i, t in rows}
    first = {}
    for i in sorted(worded):
        for s in range(len(worded[i]) - run + 1):
            first.setdefault(tuple(x for _, x in worded[i][s : s + run]), (i, s))
    out = {}
    for i, t in rows:
        own, gone = worded[i], set()
        for s in range(len(own) - run + 1):
            if first[tuple(x for _, x in own[s : s + run])] < (i, s):
                gone.update(range(s, s + run))
        ats = {own[k][0] for k in gone}
        kept = "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in ats)
        out[i] = (len(own), len(gone), sum(1 for k in gone if k - 1 not in gone), kept)
    return out


def shares(sizes, weights=(1, 2, 3), most=3):
    """Target of each source: share by weight, cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(rows, fan=3):
    """Rows of (doc_id, source, lang, n_chars, text, presented text): doc_id, leaf, subroot, root, proof_sha256, folded, verified."""
    show = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = {}
    for i, source, lang, n, text, shown in rows:
        leaf = H(*map(show, (i, source, lang, n, text)))
        claim = H(*map(show, (i, source, lang, n, shown)))
        trees.setdefault(source, []).append((i, leaf, claim))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][k : k + fan]) for k in range(0, len(out[-1]), fan)])
        return out

    def fold(built, place, node):
        siblings = []
        for level in built[:-1]:
            start = place // fan * fan
            run = level[start : start + fan]
            siblings += run[: place - start] + run[place - start + 1 :]
            run[place - start] = node
            node, place = H(*run), place // fan
        return siblings, node

    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for members in trees.values():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
    built = {s: levels([leaf for _, leaf, _ in members]) for s, members in trees.items()}
    top = levels([built[s][-1][0] for s in order]) if order else []
    out = []
    for t, s in enumerate(order):
        for p, (i, leaf, claim) in enumerate(trees[s]):
            below, node = fold(built[s], p, claim)
            above, node = fold(top, t, node)
            root = top[-1][0]
            out.append((i, leaf, built[s][-1][0], root, H(*below, *above), node, node == root))
    return out


def conversation_trie(rows, window=9, every=5):
    """Rows of (conv_id, turn, role, text): the nodes as (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda t: hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()[:16]
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[:2], digest(t)))] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % window
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, every)), [])[:h] + turns[h:])
    nodes, ends = {}, {}
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            nodes.setdefault(rebuilt[c][:d], []).append(c)
        ends.setdefault(rebuilt[c], []).append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for path in nodes:
        children[path[:-1]] += bool(path)
    for path, members in nodes.items():
        value = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += value
    return [
        (
            m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest(),
        )
        for p, m in nodes.items()
    ]
