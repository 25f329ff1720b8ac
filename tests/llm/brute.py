"""Plain Python versions of what the operators compute."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def links(texts, threshold=0.8):
    """Positions of the other texts linked with each text."""
    sets = [shingles(t) for t in texts]
    out = [set() for _ in texts]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                out[i].add(j)
                out[j].add(i)
    return out


def reach(links):
    """The first position that each position reaches."""
    label = list(range(len(links)))
    changed = True
    while changed:
        changed = False
        for i, others in enumerate(links):
            least = min([label[i], *(label[j] for j in others)])
            if least < label[i]:
                label[i], changed = least, True
    return label


def kept(texts, width=35):
    """Each text's words that no repeated window covers, and how many go."""
    all_words = [words(t) for t in texts]
    seen = {}
    for w in all_words:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out
