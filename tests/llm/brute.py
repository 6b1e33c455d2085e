"""Plain Python versions of the corpus operators, for comparison on small data."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingle_set(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(rows, percent=85):
    """doc_id -> smallest reachable doc_id, by comparing all texts that share a shingle."""
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    by = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    for k, (i, s) in enumerate(sets):
        for j in {j for x in s for j in by[x] if j < k}:
            both = len(s & sets[j][1])
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = find(i), find(sets[j][0])
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def _luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def pii(text):
    """The valid base spans: (kind, start, end)."""
    return [(k, m.start(), m.end()) for k, p, ok in PII for m in re.finditer(p, text or "") if ok(m[0])]


def line_runs(rows, min_words=50):
    """(doc_id, text) -> set of line numbers that lie in a run of lines of
    ``min_words`` words which also stands at an earlier place."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [[(p, l) for p, l in enumerate((t or "").split("\n")) if words(l)] for _, t in docs]
    seen, gone = set(), {}
    for d, own in enumerate(lines):
        count = [len(words(l)) for _, l in own]
        marked = set()
        spans = []
        for i in range(len(own)):
            for step in (1, -1):
                j, n = i, 0
                while 0 <= j < len(own) and n < min_words:
                    n += count[j]
                    j += step
                if n >= min_words:
                    spans.append((i, j - 1) if step == 1 else (j + 1, i))
        for a, b in sorted(set(spans)):
            content = tuple(l for _, l in own[a:b + 1])
            if content in seen:
                marked.update(p for p in range(own[a][0], own[b][0] + 1))
            seen.add(content)
        gone[docs[d]] = marked
    return gone


def quality_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    cover = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))


def item_matches(text, items, similar=0.8):
    """(item_id) -> best plain similarity of an item-sized window, where it
    reaches ``similar`` (weights are equal when no shingle is in two items)."""
    w = words((text or "").translate(LOWER))
    out = {}
    for item, t in items:
        iw = words((t or "").translate(LOWER))
        a = shingle_set(" ".join(iw))
        best = 0.0
        for s in range(max(1, len(w) - len(iw) + 1) if iw and w else 0):
            b = shingle_set(" ".join(w[s:s + len(iw)]))
            best = max(best, len(a & b) / len(a | b))
        if best >= similar:
            out[item] = best
    return out


def mix_copies(rows):
    """(doc_id, source, text) -> copies taken of each document."""
    import hashlib
    size = {r: len(words(r[2])) for r in rows}
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total = {s: sum(size[r] for r in rows if r[1] == s) for s in names}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(total.values()), set(names)
    while left > 1e-9 and open_:
        share, left = left / sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=names.index):
            target[s] += share * weight[s]
            if target[s] > 2 * total[s]:
                left += target[s] - 2 * total[s]
                target[s] = 2.0 * total[s]
                open_ = open_ - {s}
    rank = lambda r: int(hashlib.md5(f"7:{r[0]}".encode()).hexdigest()[:15], 16)
    out, before = {}, dict.fromkeys(names, 0)
    for r in sorted(rows, key=lambda r: (rank(r), size[r])):
        at = [before[r[1]] + k * total[r[1]] + size[r] / 2 for k in range(2)]
        out[r] = sum(size[r] > 0 and x <= target[r[1]] + 1e-6 for x in at)
        before[r[1]] += size[r]
    return out, target, total
