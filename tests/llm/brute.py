"""Plain versions of the operators, over lists of Python values."""

import re

UPPER = {c: c + 32 for c in range(65, 91)}
BLANK = " \t\n\x0b\x0c\r"


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(rows, size, threshold):
    """rows of (id, text) to (id, set size, smallest id reachable)."""
    sets = [shingle_set(text, size) for _, text in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[top(i)] = min(least.get(top(i), name), name)
    return [(name, len(sets[i]), least.get(top(i)) if sets[i] else name) for i, (name, _) in enumerate(rows)]


def line_key(line):
    return line.strip(BLANK).translate(UPPER)


def without_common_lines(texts, least):
    counts = {}
    for text in texts:
        for key in {line_key(line) for line in (text or "").split("\n")}:
            counts[key] = counts.get(key, 0) + 1
    common = {k for k, n in counts.items() if k and n >= least}
    return ["\n".join(x for x in (t or "").split("\n") if line_key(x) not in common) for t in texts]


def contained(text, items, size, threshold):
    own = shingle_set(text, size)
    out = []
    for name, item in items:
        wanted = shingle_set(item, size)
        if wanted and 100 * len(wanted & own) >= threshold * len(wanted):
            out.append(name)
    return sorted(out)
