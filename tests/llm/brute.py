"""The operators' results by plain loops, for small inputs."""

import hashlib
import re
from itertools import combinations

ALNUM = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
WORDS = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def quality(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n, again = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), again,
            n < 20 or 100 * again > 30 * n)


def contamination(text, items, width=10):
    words, hit, names = normal_words(text), set(), set()
    for item, body in items:
        own = normal_words(body)
        size = min(width, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            for j in range(len(words) - size + 1):
                if words[j:j + size] == own[i:i + size]:
                    hit.update(range(j, j + size))
                    names.add(str(item))
    return len(words), len(hit), sorted(names)


def shingles(text, width):
    words = WORDS.findall((text or "").translate(LOWER))
    size = min(width, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def components(docs, width, percent=80):
    """{doc_id: (set size, component)}; ids are distinct."""
    sets = {d: shingles(t, width) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def without_repeats(docs, width=20):
    """{doc_id: (words, removed, kept words)}; ids are distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i:i + width])
            if window in seen:
                gone[i:i + width] = [True] * width
            seen.add(window)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[doc_id] = (len(words), sum(gone), kept)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def phrases(text, base):
    words = normal_words(text)
    found = [(i, label) for phrase, label in base for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in found})))


def template_runs(words, own, least):
    """Start, start in the template and length of every common run that is longer on neither side."""
    found = []
    for i in range(len(words)):
        for j in range(len(own)):
            if words[i] == own[j] and not (i and j and words[i - 1] == own[j - 1]):
                size = 1
                while i + size < len(words) and j + size < len(own) and words[i + size] == own[j + size]:
                    size += 1
                if size >= least:
                    found.append((i, j, size))
    return found


def template_cover(words, own, least, gap):
    """Largest share of a template that runs in the order of both texts cover."""
    best = []
    for at, place, size in sorted(template_runs(words, own, least)):
        top = size
        for covered, upto, used in best:
            skip = max(0, used - place, upto - at)
            if skip < size and at - upto <= gap and place + size > used:
                top = max(top, covered + size - skip)
        best.append((top, at + size, place + size))
    return max((b[0] for b in best), default=0) / len(own)
