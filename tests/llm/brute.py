"""Plain, slow versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def shingle_set(text, width=5):
    w = SPACE_WORDS.findall(lower(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def groups(sets, percent=75):
    """Least key reachable over links of sets (dict key -> set)."""
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    index = {}
    for k, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(k)
    for a, b in {p for held in index.values() for p in itertools.combinations(sorted(held), 2)}:
        same = len(sets[a] & sets[b])
        if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in sets}


def paragraphs(text, min_words):
    """Line number -> shingle set of lines with enough words."""
    return {n: shingle_set(line) for n, line in enumerate((text or "").split("\n")) if len(SPACE_WORDS.findall(line)) >= min_words}


def without_repeats(docs, length=100):
    """docs: [(doc_id, text)] by id -> {doc_id: (n_bytes, n_removed, n_spans, sha256 of what stays)}."""
    seen, out = set(), {}
    for doc, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[doc] = (len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def best_edits(pattern, text):
    """Least edits between the pattern and any substring of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
        row = new
    return min(row)


def normal(s):
    return re.sub(r"[\x20\x09-\x0D]+", " ", lower(s)).strip(" ")


def budget(item, q=12, percent=6):
    m = len(normal(item))
    return max(0, min(m * percent // 100, (m - q) // q))


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = SPACE_WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORDS.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def license_base(text, phrases):
    w = LICENSE_WORDS.findall(lower(text))
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def _mixed(x):
    """A public 64-bit finaliser; the first 40 bits order equally frequent grams."""
    m = (1 << 64) - 1
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & m
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & m
    return (x ^ x >> 31) >> 24


def gram_counts(text):
    """Counter of n-grams (1 to 3) of lower-case letters; all else is a word edge."""
    s = [0]
    for c in text or "":
        low = c.lower()
        s.append((ord(low) if len(low) == 1 else ord(c)) if c.isalpha() else 0)
    s.append(0)
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            w = s[i:i + n]
            if all(w[1:-1]) and (w[0] or w[-1]):
                h = 0
                for x in w:
                    h = h * 0x110000 + x & (1 << 64) - 1
                out[_mixed(h if n == 1 else (h + n) & (1 << 64) - 1)] += 1
    return out


def by_rank(counts, most=300):
    return [g for g, _ in sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:most]]


def language_profiles(rows):
    """[(doc_id, text, lang)] -> lang -> grams by rank, from the rows that aren't held out."""
    per = {}
    for doc_id, text, lang in rows:
        if text is not None and lang is not None and not is_held_out(doc_id):
            per.setdefault(lang, Counter()).update(gram_counts(text))
    return {k: by_rank(c) for k, c in sorted(per.items())}


def language_of(text, profiles):
    """(language, score) by out-of-place distance."""
    mine = by_rank(gram_counts(text))
    if not mine or not profiles:
        return "und", 0.0
    best = None
    for lang, theirs in profiles.items():
        place = {g: i for i, g in enumerate(theirs)}
        far = sum(abs(place[g] - i) if g in place else 300 for i, g in enumerate(mine))
        best = min(best or (far, lang), (far, lang))
    return best[1], 1 - best[0] / (300 * len(mine))


def languages_kept(rows):
    """Ids that the language stage keeps."""
    profiles = language_profiles(rows)
    judged = {d: language_of(t, profiles) for d, t, _ in rows}
    if not profiles:
        return {d for d, t, _ in rows if any(c.isalpha() for c in t or "")}
    reach = {}
    for d, t, lang in rows:
        if t is not None and lang is not None and not is_held_out(d) and judged[d][0] != "und":
            reach.setdefault(judged[d][0], []).append(judged[d][1])
    bound = {k: 0.75 * sorted(v)[max(0, -(-len(v) // 1000) - 1)] for k, v in reach.items()}
    return {d for d, (lang, score) in judged.items() if lang != "und" and score >= bound.get(lang, 0.0)}
