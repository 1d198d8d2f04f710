"""Plain Python versions of the operators, one document at a time."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def remove_repeats(docs, window=50):
    first = {}
    for d, t in docs:
        x = words(t)
        for i in range(len(x) - window + 1):
            key = tuple(x[i : i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        x = words(t)
        gone = set()
        for i in range(len(x) - window + 1):
            if d is not None and first[tuple(x[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(x), len(gone), sha(" ".join(y for i, y in enumerate(x) if i not in gone))))
    return out


def dedup_lines(docs, least_docs=10, least_chars=1):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    count = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")} if len(k) >= least_chars)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count[key(x)] < least_docs]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text, k):
    x = words((text or "").translate(LOWER))
    return {tuple(x[i : i + k]) for i in range(len(x) - k + 1)} if len(x) >= k else {tuple(x)} - {()}


def jaccard_groups(docs, k=3, percent=90):
    sets = [frozenset(shingles(t, k)) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    found = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            found[x].append(i)
    pairs = Counter()
    for at in found.values():
        for n, i in enumerate(at):
            for j in at[n + 1 :]:
                pairs[i, j] += 1
    for (i, j), n in pairs.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)].append(d)
    return [(d, len(sets[i]), min(ids[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def quality(docs):
    out = []
    for d, t in docs:
        t = t or ""
        x = words(t)
        count = Counter(tuple(x[i : i + 3]) for i in range(len(x) - 2))
        cover = {i + j for i in range(len(x) - 2) if count[tuple(x[i : i + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        failed = len(x) < 50 or 100 * len(cover) > 50 * len(x)
        out.append((d, len(x), sum(map(len, x)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), failed))
    return out


def secrets(docs):
    kinds = [
        ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    out = []
    for d, t in docs:
        found = [[(m.start(), i, m.end()) for m in rx.finditer(t or "") if ok(m)] for i, (_, rx, ok) in enumerate(kinds)]
        spans = sorted(x for part in found for x in part)
        out.append((d, *map(len, found), sha(",".join(f"{kinds[i][0]}:{a}:{b}" for a, i, b in spans))))
    return out


def captures(pages, least=0):
    first = {}
    for p, html in pages:
        first[html or ""] = min(first.get(html or "", p), p)
    out = []
    for p, html in pages:
        raw = (html or "").encode()
        own = len(raw) < least or first[html or ""] == p
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else first[html or ""]))
    return out


def pieces_cover(rows, docs, tokenizer, window=2048):
    """Packed pieces against whole tokenisations; rows: (doc_id, start, length, crc, total, sequence, offset)."""
    by, at = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
        at[r[5]].append(r)
    assert set(by) == {d for d, _ in docs}
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        end = 0
        for _, start, length, crc, total, _, _ in sorted(by[d], key=lambda r: r[1]):
            assert start == end and total == len(ids)
            end += length
            assert crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[start:end]))
        assert end == len(ids)
    for part in at.values():
        end = 0
        for r in sorted(part, key=lambda r: r[6]):
            assert r[6] == end
            end += r[2]
        assert end <= window
    return len(at)
