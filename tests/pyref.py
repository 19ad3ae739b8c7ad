"""Plain-Python statements of the semantics (test expectations only)."""

import re
import string
from collections import Counter
from math import sqrt

STOP = {"of", "and", "or", "feat", "featuring", "ft", "the"}


def tokens(artist):
    """Lower-case, keep word characters and whitespace, drop stop words; set of words."""
    if artist is None:
        return None
    kept = re.sub(r"[^\w\s]", "", artist.lower())
    words = [w for w in kept.split() if w not in STOP]
    return set(" ".join(words).split(" "))


def cosine(a, b):
    if a is None or b is None:
        return 0.0
    strip = str.maketrans("", "", string.punctuation)
    ca, cb = Counter(a.lower().translate(strip)), Counter(b.lower().translate(strip))
    dot = sum(n * cb[ch] for ch, n in ca.items())
    na, nb = sum(n * n for n in ca.values()), sum(n * n for n in cb.values())
    return dot / (sqrt(na) * sqrt(nb)) if na > 0 and nb > 0 else 0.0


def declump(artists, passes):
    """Returns the final order as indices into ``artists``."""
    order = list(range(len(artists)))
    for _ in range(passes):
        toks = [tokens(artists[i]) for i in order]
        keys = []
        for pos in range(len(order)):
            prev = toks[pos - 1] if pos > 0 else None
            hit = toks[pos] is not None and prev is not None and bool(toks[pos] & prev)
            keys.append(pos + 2.5 if hit else float(pos))
        order = [i for _, i in sorted(zip(keys, order))]
    return order
