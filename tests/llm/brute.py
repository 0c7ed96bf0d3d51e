"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lower(text):
    return (text or "").translate(UPPER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near_components(rows, k, percent):
    """{row number: (set size, component's smallest id)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = SPACED.findall(lower(text))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


def decontaminated(text, items, window=10):
    w = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for name, item in items:
        v = ALNUM.findall(lower(item))
        k = min(window, len(v))
        windows = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(str(name))
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def hit_words(text, items, window=10):
    w, hit = ALNUM.findall(lower(text)), set()
    for _, item in items:
        v = ALNUM.findall(lower(item))
        k = min(window, len(v))
        windows = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
        hit.update(p for i in range(len(w) - k + 1) if tuple(w[i:i + k]) in windows for p in range(i, i + k))
    return hit


def line_dedup(rows, min_length=40, min_docs=5):
    """rows: (doc_id, text), ids not null."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= min_length:
                holders.setdefault(key, set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            h = holders.get(lower(line.strip(" \t\n\x0b\x0c\r")), ())
            if len(h) < min_docs or max(h) == doc:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def remove_repeats(rows, window=50):
    first = {}
    texts = [(doc, SPACED.findall(text or "")) for doc, text in rows]
    for doc, w in texts:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, w in texts:
        gone = {p for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < doc for p in range(i, i + window)}
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def text_stats(text):
    w, n = SPACED.findall(text or ""), 0
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i:i + 8]), []).append(i)
    repeated = {p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    seen = set()
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            n += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), n, len(repeated)


PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def licences(text):
    w, starts, labels = ALNUM.findall(lower(text)), [], set()
    for label, phrase in PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: target}, resharing the excess until none is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit > cap * sizes[s]}
        if not over:
            return out | {s: weight[s] * unit for s in free}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        free -= over
    return out


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def notices(text, templates, agreement=0.75):
    """(labels, score): every place with a template's key phrase, aligned in full."""
    w, labels, score = ALNUM.findall(lower(text)), set(), 0.0
    for label, notice, phrase in templates:
        t, k = ALNUM.findall(lower(notice)), ALNUM.findall(lower(phrase))
        a = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
        slack, end = max(2, len(t) // 3), a + len(k)
        for p in (p for p in range(len(w)) if w[p:p + len(k)] == k):
            n = (common(t[:a], w[max(0, p - a - slack):p]) + len(k)
                 + common(t[end:], w[p + len(k):p - a + len(t) + slack]))
            if n >= agreement * len(t):
                labels.add(label)
                score = max(score, n / len(t))
            score = max(score, len(k) / len(t))
    return labels, score
