"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import random
import re

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def words(text):
    return SPLIT.findall(text or "")


def kept_words(docs, size):
    """docs: (id, text); per document (n_words, n_removed, kept). Equal (id, text) count once."""
    first = {}
    for key, text in docs:
        w = words(text)
        for i in range(len(w) - size + 1):
            place, gram = (-(2**63) if key is None else key, i), tuple(w[i : i + size])
            first[gram] = min(first.get(gram, place), place)
    out = []
    for key, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (-(2**63) if key is None else key, i):
                gone.update(range(i, i + size))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_duplicates(docs):
    """docs: (id, text) with different ids; per id (n_shingles, component, kept)."""
    sets = {key: shingles(text) for key, text in docs}
    names = {key: key for key in sets}

    def find(x):
        while names[x] != x:
            x = names[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                names[y] = x
    return {key: (len(sets[key]), find(key), find(key) == key) for key in keys}


def invented(seed, count, length, vocabulary=400):
    """Texts with copies, near copies and passages in common."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for _ in range(count):
        kind = rng.random()
        own = [rng.choice(vocab) for _ in range(rng.randint(1, length))]
        if kind < 0.15 and texts:
            own = rng.choice(texts).split(" ")
        elif kind < 0.4 and texts:
            own = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
        elif kind < 0.6:
            cut = rng.randint(0, 30)
            at = rng.randint(0, len(own))
            own[at:at] = passage[cut:]
        texts.append(" ".join(own))
    return texts
