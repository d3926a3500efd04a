"""Plain versions of the operators' contracts, for comparison on small tables."""

import hashlib
import re
import string
from collections import defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for order, kind, pattern, ok in (
            (0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            (1, "ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
            (2, "card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
            (3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15)):
        out += [(order, m.start(), m.end(), kind) for m in re.finditer(pattern, text) if ok(m)]
    return sorted(out)


def secrets(text):
    text, out = text or "", []
    assign = (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
              r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for order, kind, pattern, ok in ((0, "assign", assign, lambda m: len(m[2]) >= 8),
                                     (1, "access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
                                     (2, "hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32)):
        out += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text) if ok(m)]
    return sorted(out)


def quality(text):
    text = text or ""
    words = BLANK_WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK_WORD.search(line):
            dup += line in seen
            seen.add(line)
    where = defaultdict(list)
    for i in range(len(words) - 4):
        where[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items):
    """docs: texts; items: (id, text). Per text (n_words, n_hit, n_items, digest, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i:i + n])].add("" if item is None else str(item))
    out = []
    for text in docs:
        w, hit, ids = bench_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    ids |= found
        out.append((len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def shingle_set(text):
    w = BLANK_WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard_components(docs):
    """docs: {id: [texts]}; {id: smallest id reachable}."""
    sets = [(i, shingle_set(t)) for i, texts in docs.items() for t in texts]
    parent = {i: i for i in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in docs}
