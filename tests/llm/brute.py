"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

from muniscope.llm import fingerprint, line_dedup
from muniscope.llm.common import span_hashes

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_sets(rows, size):
    out = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        out[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return out


def components(rows, size, percent=80):
    sets = shingle_sets(rows, size)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in holders[g])
        for j, k in shared.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for g in sets[i]:
            holders[g].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeats(rows, depth=100):
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - depth + 1):
            if b[p : p + depth] in seen:
                gone[p : p + depth] = True
            seen.add(b[p : p + depth])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out[i] = (len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest())
    return out


def lines(rows):
    """Number of lines, removed lines and the text left."""
    held = {}
    for i, t in rows:
        each = (t or "").split("\n")
        code = np.array([span_hashes(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x.encode())]), seed=3)[0] for x in each], np.uint64)
        held[i] = each, [(k, "\n".join(each[k : k + n]), n) for k, n in zip(*[x.tolist() for x in line_dedup.chunks(code)], strict=True)]
    first, out = {}, {}
    for i, (_, own) in held.items():
        for k, chunk, _ in sorted(own):
            first.setdefault(chunk, (i, k))
    for i, (each, own) in held.items():
        gone = set()
        for k, chunk, n in own:
            doc, at = first[chunk]
            if doc != i or k >= at + n:
                gone |= set(range(k, k + n))
        out[i] = (len(each), len(gone), "\n".join(x for k, x in enumerate(each) if k not in gone))
    return out


def chunks(raw):
    """Content-defined chunks of a text, byte by byte."""
    out, at = [], 0
    while at < len(raw):
        end, stop = None, min(at + fingerprint.MOST, len(raw))
        if len(raw) - at > fingerprint.LEAST:
            for p in range(at + fingerprint.LEAST, stop + 1):
                gear = 0
                for age in range(16):
                    if p - 1 - age >= 0:
                        gear += int(fingerprint.GEAR[raw[p - 1 - age]]) << age
                mask = fingerprint.STRICT if p <= at + fingerprint.USUAL else fingerprint.LOOSE
                if gear % 2**32 & int(mask) == 0:
                    end = p
                    break
        end = end or (stop if len(raw) - at > fingerprint.LEAST else len(raw))
        out.append(raw[at:end])
        at = end
    return out


def containment(a, b):
    """Share of the bytes of a's different chunks that b has too."""
    a, b = set(chunks(a)), set(chunks(b))
    total = sum(map(len, a))
    return sum(len(c) for c in a & b) / total if total else float(not b)


def hit_words(text, windows):
    """Words of a text and those inside a benchmark window."""
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit = set()
    for n in {len(x) for x in windows}:
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                hit.update(range(k, k + n))
    return len(w), len(hit)


def windows(items, size=13):
    out = set()
    for t in items:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        if w:
            n = min(size, len(w))
            out.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    return out
