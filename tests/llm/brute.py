"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^ \t-\r]+")


def words(text):
    return WORD.findall(text or "")


def null_first(i):
    return (i is not None, i or 0)


def line_dedup(rows, k=3):
    """[(id, text)] -> [(id, n_lines, n_removed, kept text)]."""
    wins = []
    for n, (i, text) in enumerate(rows):
        at = [(p, x) for p, x in enumerate((text or "").split("\n")) if words(x)] if text is not None else []
        for s in range(len(at) - k + 1):
            run = at[s:s + k]
            wins.append((tuple(x for _, x in run), null_first(i), run[0][0], run[-1][0], n))
    first = {}
    for w, i, a, _, _ in wins:
        first[w] = min(first.get(w, (i, a)), (i, a))
    gone = defaultdict(set)
    for w, i, a, b, n in wins:
        if (i, a) != first[w]:
            gone[n] |= set(range(a, b + 1))
    out = []
    for n, (i, text) in enumerate(rows):
        ls = text.split("\n") if text is not None else []
        kept = [x for p, x in enumerate(ls) if p not in gone[n]]
        out.append((i, len(ls), len(ls) - len(kept), None if text is None else "\n".join(kept)))
    return out


def substring_dedup(rows, k=20):
    """[(id, text)] -> [(id, n_words, n_removed, kept text)]."""
    first = {}
    for i, text in rows:
        w = words(text)
        for s in range(len(w) - k + 1):
            x, p = tuple(w[s:s + k]), (null_first(i), s)
            first[x] = min(first.get(x, p), p)
    out = []
    for i, text in rows:
        w, gone = words(text), set()
        for s in range(len(w) - k + 1):
            if first[tuple(w[s:s + k])] != (null_first(i), s):
                gone |= set(range(s, s + k))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def base_quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if words(x):
            dup += x in seen
            seen.add(x)
    wins = Counter(tuple(w[s:s + 5]) for s in range(len(w) - 4))
    rep = {p for s in range(len(w) - 4) if wins[tuple(w[s:s + 5])] > 1 for p in range(s, s + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(rep),
            len(w) < 10 or 100 * len(rep) > 20 * len(w))


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: size} -> {source: target}: reshare by weight until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        got = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if got[s] > most * sizes[s] + 1e-9]
        if not over:
            return {**capped, **got}
        capped.update({s: most * sizes[s] for s in over})


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def mix_copies(rows, seed="mix-1"):
    """[(id, text, source)] -> [(size, source size, target, copies)], by systematic sampling."""
    size = [len(words(t)) for _, t, _ in rows]
    sizes = defaultdict(int)
    for n, (_, _, s) in zip(size, rows):
        sizes[s] += n
    goal = targets(sizes)
    order = defaultdict(list)
    for k, (i, t, s) in enumerate(rows):
        h, n = md5(("null" if i is None else str(i)) + "/" + (t or "")), str(size[k])
        order[s].append((len(n) * 100 + int((n + "0")[:2]), h[:2], size[k], h[2:16], k))
    copies = {}
    for s, docs in order.items():
        each = goal[s] / sizes[s] if sizes[s] else 0.0
        name = seed + ("/null" if s is None else "/s:" + s)
        u = int(hashlib.sha256(name.encode()).hexdigest()[:5], 16) / 1048576
        for r, (*_, k) in enumerate(sorted(docs), 1):
            copies[k] = int((each * r + u) // 1) - int((each * (r - 1) + u) // 1)
    return [(size[k], sizes[rows[k][2]], goal[rows[k][2]], copies[k]) for k in range(len(rows))]
