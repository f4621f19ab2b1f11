"""The same operations on small tables, written the plain way."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def repeats(rows, window):
    """Words, removed words and checksum of what is kept, by rows of (id, text)."""
    late = 1 << 63
    first = {}
    words = [(late if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for i, own in words:
        for p in range(len(own) - window + 1):
            run = tuple(own[p : p + window])
            first[run] = min(first.get(run, i), i)
    found = []
    for i, own in words:
        gone = set()
        for p in range(len(own) - window + 1):
            if first[tuple(own[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        found.append((len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return found


def shingles(text, size):
    own = (text or "").encode().translate(LOWER).split()
    n = min(size, len(own))
    return frozenset(tuple(own[k : k + n]) for k in range(len(own) - n + 1)) if own else frozenset()


def near_copies(rows, size, percent):
    """Set size and component by id; every pair of documents is compared."""
    sets = {i: shingles(t, size) for i, t in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = collections.defaultdict(list)
    for i, own in sets.items():
        for run in own:
            holders[run].append(i)
    common = collections.Counter((a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[k + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    return {i: (len(own), find(i)) for i, own in sets.items()}


def base_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    counts = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = set()
    for i in range(len(words) - 7):
        if counts[tuple(words[i : i + 8])] > 1:
            again.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(x) for x in "#*$%&|<>"), dup, len(again), failed


def leaks(docs, items, overlap=0.8):
    """Items whose five-word runs a document has in this share."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())

    def runs(own):
        return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} - {()}

    wanted = {i: runs(words(t)) for i, t in items}
    found = {}
    for d, t in docs:
        own = runs(words(t))
        found[d] = sorted(i for i, r in wanted.items() if r and len(r & own) >= overlap * len(r))
    return found
