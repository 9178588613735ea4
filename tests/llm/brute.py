"""Plain versions of the text operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def quality(text):
    words = WORD.findall(text or "")
    seen = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if seen[tuple(words[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k:k + size]) for k in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def components(rows, size=5, similar=75):
    """rows: (id, text) -> [(id, size, component, kept)]; ids may be null or repeat."""
    sets = [shingles(text, size) for _, text in rows]
    of = list(range(len(rows)))

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if a and 100 * same >= similar * (len(a) + len(sets[j]) - same):
                of[root(i)] = root(j)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        members[root(i)].append(key)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [(key, len(sets[i]), key if not sets[i] else least[root(i)], (key if not sets[i] else least[root(i)]) == key) for i, (key, _) in enumerate(rows)]


def repeated_words(rows, width=13):
    """rows: (id, text) -> [(id, words, removed, digest of the kept text)]."""
    last = float("inf")
    order = lambda key: last if key is None else key
    low = {}
    cut = [(key, WORD.findall(text or "")) for key, text in rows]
    for key, words in cut:
        for k in range(len(words) - width + 1):
            window = tuple(words[k:k + width])
            low[window] = min(low.get(window, last), order(key))
    out = []
    for key, words in cut:
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if low[tuple(words[k:k + width])] < order(key):
                gone[k:k + width] = [True] * width
        out.append((key, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def repeated_bytes(rows, width=200):
    """rows: (id, text) -> [(id, bytes, removed, spans, digest of the rest)]."""
    texts = [(key, (text or "").encode()) for key, text in rows]
    seen = Counter(b[k:k + width] for _, b in texts for k in range(len(b) - width + 1))
    out = []
    for key, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if seen[b[k:k + width]] > 1:
                gone[k:k + width] = b"\1" * width
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((key, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def leaks(docs, items, width=13, allowed=2):
    """{(doc id, item id): [(start, words, equal, item words), one per text]}"""
    out = defaultdict(list)
    for key, text in set(docs):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        for item, body in set(items):
            own = re.findall(r"[^\W_]+", (body or "").lower())
            if len(own) < 8:
                continue
            size, may = min(width, len(own)), allowed if len(own) >= width else 0
            best = None
            for shift in range(1 - len(own), len(words)):
                low, high = max(0, -shift), min(len(own), len(words) - shift)
                equal = [own[j] == words[j + shift] for j in range(low, high)]
                good = [s for s in range(len(equal) - size + 1) if sum(equal[s:s + size]) >= size - may]
                if good:
                    stop = good[-1] + size
                    found = (sum(equal[good[0]:stop]), -(good[0] + low + shift), stop - good[0])
                    best = found if best is None else max(best, found)
            if best:
                out[key, item].append((-best[1], best[2], best[0], len(own)))
    return {k: sorted(v) for k, v in out.items()}


def poured(sizes, weights, share, epochs):
    """Targets by rounds: clamp what is above its cap, share the rest anew."""
    left, open_, target = share * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if weights[s] * left / total > epochs * sizes[s]] if total else []
        if not over:
            return target | {s: weights[s] * left / total if total else 0.0 for s in open_}
        for s in over:
            target[s] = float(epochs * sizes[s])
            open_.remove(s)
        left -= sum(target[s] for s in over)
    return target


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def variants(rows, slip=31, length=7, count=2, times=10):
    """rows: (id, text) -> [(word, form, root, n, near words, the form's n)]"""
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= length and k >= count}
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n]


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranking(rows, items, k=20):
    """rows, items: (id, text) -> [(item, rank, id, score)]"""
    docs = [(key, Counter(TERM.findall((text or "").translate(LOWER)))) for key, text in rows]
    docs = [(key, tf, sum(tf.values())) for key, tf in docs if tf]
    total, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, tf, _ in docs for t in tf)
    out = []
    for item, text in items:
        query = Counter(TERM.findall((text or "").translate(LOWER)))
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in query}
        scored = []
        for key, tf, n in docs:
            m = 100 - 25 + (25 * n * total) // length
            score = sum(times * weight[t] * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t, times in query.items() if t in tf)
            if score > 0:
                scored.append((-score, key is None, key))
        out += [(item, rank + 1, key, -minus) for rank, (minus, _, key) in enumerate(sorted(scored)[:k])]
    return out
