"""Plain versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(nodes, links):
    """Smallest node reachable by links."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def shingles(text, n=4):
    words = WORD.findall(lowered(text))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jaccard_classes(rows, percent=85, n=4):
    """rows: (id, text). Returns {id: (n_shingles, component)}."""
    sets = {i: shingles(t, n) for i, t in rows}
    by = {}
    for i, s in sets.items():
        for t in s:
            by.setdefault(t, []).append(i)
    common = {}
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [
        (a, b) for (a, b), c in common.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)
    ]
    part = components(sets, links)
    return {i: (len(s), part[i]) for i, s in sets.items()}


KINDS = ["assign", "access", "hex"]


def base_spans(text):
    """Pattern spans of secrets, found with plain loops over matches."""
    text = text or ""
    keys = "|".join("".join(f"[{c}{c.upper()}]" for c in k) for k in ("password", "passwd", "secret", "token"))
    keys += "|[aA][pP][iI]_?[kK][eE][yY]"
    assign = re.compile(rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def ppm_log10(train, text, order):
    """log10 probability of a text's bytes and end under a context trie, symbol by symbol."""
    from collections import Counter, defaultdict
    from math import log10

    seen = defaultdict(Counter)
    lead = bytes([255]) * order

    def symbols(t):
        data = lead + t + bytes([254])
        for i in range(order, len(data)):
            yield data[i - order : i], data[i]

    for t in train:
        for context, symbol in symbols(t):
            for k in range(order + 1):
                seen[context[order - k :]][symbol] += 1
    total = 0.0
    for context, symbol in symbols(text):
        excluded = set()
        for k in range(order, -1, -1):
            left = {s: c for s, c in seen.get(context[order - k :], {}).items() if s not in excluded}
            if not left:
                continue
            n, d = sum(left.values()), len(left)
            if symbol in left:
                total += log10(left[symbol] / (n + d))
                break
            total += log10(d / (n + d))
            excluded |= set(left)
        else:
            total -= log10(255 - len(excluded))
    return total


def cosine_classes(rows, threshold=0.9):
    """rows: (id, vector). Returns {id: (n_links, component, kept)}."""
    import numpy as np

    good = [
        (i, np.array(v, float)) for i, v in rows
        if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)
    ]
    links = [
        (a, b) for k, (a, x) in enumerate(good) for b, y in good[k + 1 :]
        if len(x) == len(y) and float(x @ y) / (float(x @ x) * float(y @ y)) ** 0.5 >= threshold
    ]
    part = components([i for i, _ in rows], links)
    degree = {i: 0 for i, _ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return {i: (degree[i], part[i], part[i] == i) for i, _ in rows}
