"""Plain versions of the operators, for small inputs."""

import re
import zlib

SEPARATED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def shingles(text, n):
    words = SEPARATED.findall(lower_ascii(text))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[i:] for i in range(n)]))


def classes(rows, n, percent):
    """[(doc_id, n_shingles, component_id, n_links)] of [(doc_id, text)], by comparing all pairs that share an n-gram."""
    sets = [shingles(t, n) for _, t in rows]
    lists, root, links = {}, list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in lists.get(g, ()):
                shared[j] = shared.get(j, 0) + 1
            lists.setdefault(g, []).append(i)
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows)]


def places(text, phrases):
    """[(label, first word)] of each phrase, and the number of words."""
    words = WORDS.findall(lower_ascii(text))
    found = []
    for label, phrase in phrases:
        p = phrase.split()
        found += [(label, i) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return found, len(words)


def secret_spans(text):
    """Base spans by kind: [(start, kind, stop)]."""
    text = text or ""
    out = []
    for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.ASCII):
        if len(m[1]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def private_spans(text):
    text = text or ""
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)
