"""Plain versions of the operators, one document at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def exact(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    return [
        (d, max(groups[t or ""]), len(groups[t or ""]), d == max(groups[t or ""]), sha(t or ""))
        for d, t in docs
    ]


def shingles(text, n):
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def similar(docs, n, percent):
    sets = {d: shingles(t, n) for d, t in docs}
    up, links = {d: d for d in sets}, Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    for d, s in sets.items():
        shared = Counter(o for x in s for o in holders[x] if o > d)
        for o, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[o]) - both):
                a, b = root(d), root(o)
                up[max(a, b)] = min(a, b)
                links.update((d, o))
    return [(d, len(sets[d]), root(d), links[d]) for d, _ in docs]


def repeated_bytes(docs, span):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, sha(kept)))
    return out


def repeated_phrases(docs, span):
    first = {}
    words = {}
    for d, t in sorted(docs):
        words[d] = w = WORD.findall(t or "")
        for i in range(len(w) - span + 1):
            first.setdefault(tuple(w[i : i + span]), (d, i))
    out = []
    for d, w in words.items():
        keep = [True] * len(w)
        for i in range(len(w) - span + 1):
            if first[tuple(w[i : i + span])] != (d, i):
                keep[i : i + span] = [False] * span
        kept = " ".join(x for x, k in zip(w, keep) if k)
        out.append((d, len(w), len(w) - sum(keep), sha(kept)))
    return out


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in earlier
            earlier.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated),
        len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


def line_key(line):
    return lower(line.strip(SPACE))


def drop_lines(docs, least):
    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            holders[line_key(line)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not line_key(x) or len(holders[line_key(x)]) < least]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept)), "\n".join(kept)))
    return out


def pieces(docs, tokenizer, size):
    out = []
    for d, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for p, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            out.append((d, p, start, len(part), crc))
    return out
