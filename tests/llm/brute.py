"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(text):
    return (text or "").translate(FOLD)


def words(text):
    return WORD.findall(fold(text))


def phrase_places(text, phrases):
    found = words(text)
    out = defaultdict(list)
    for label, phrase in phrases.items():
        own = phrase.split()
        for i in range(len(found) - len(own) + 1):
            if found[i : i + len(own)] == own:
                out[label].append(i)
    return out


def template_matches(text, templates, containment, step):
    found, out = words(text), set()
    for start in range(0, max(1, len(found)), step):
        block = set(found[start : start + 2 * step])
        for name, template in templates.items():
            own = set(template.split())
            if len(own & block) >= containment * len(own) - 1e-9:
                out.add(name)
    return out


def contamination(text, items, window):
    found = words(text)
    hit, who = set(), set()
    for item, item_text in items:
        own = words(item_text)
        m = min(window, len(own))
        windows = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(found) - m + 1):
            if m and tuple(found[i : i + m]) in windows:
                hit.update(range(i, i + m))
                who.add(str(item))
    return len(found), len(hit), sorted(who)


def shingles(text, size):
    found = BLANK.findall(fold(text))
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def near_components(rows, size, num, den):
    """id: (set size, component) over rows with distinct ids."""
    sets = {i: shingles(t, size) for i, t in rows}
    group = {i: i for i in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if den * shared >= num * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = sorted((top(i), top(j)))
                    group[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}
