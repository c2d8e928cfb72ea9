"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SEPARATORS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return re.findall(rf"[^{SEPARATORS}]+", text or "")


def sha256(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def quality(rows, line_docs, line_share, kept_share, min_words=10, max_repeat_share=20):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of (doc_id, source, text)."""
    def normal(line):
        return re.sub("[0-9]+", "0", " ".join(words(line.translate({c: c + 32 for c in range(65, 91)}))))

    texts_with, texts_of = defaultdict(set), defaultdict(set)
    for _, host, text in rows:
        texts_of[host] |= {text} if words(text) else set()
        for line in (text or "").split("\n"):
            if words(line):
                texts_with[host, normal(line)].add(text)
    out = []
    for doc, host, text in rows:
        found, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
        windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
        often = Counter(windows)
        repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
        left = sum(len(words(x)) for x in lines
                   if not (len(texts_with[host, normal(x)]) > line_docs and len(texts_with[host, normal(x)]) > line_share * len(texts_of[host])))
        failed = len(found) < min_words or 100 * len(repeated) > max_repeat_share * len(found)
        out.append((doc, len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
                    len(repeated), failed, not failed and left >= kept_share * len(found)))
    return out


def repeats(rows, width=20):
    """(doc_id, n_words, n_removed, sha256 of the kept words) of (doc_id, text)."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        found, gone = words(text), set()
        for i in range(len(found) - width + 1):
            window = tuple(found[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        out.append((doc, len(found), len(gone), sha256(" ".join(w for i, w in enumerate(found) if i not in gone))))
    return out


def cut(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the kept bytes) of (doc_id, text)."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if (part := hash(data[i : i + length])) in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(part)
        out.append((doc, len(data), sum(gone), sum(a and not b for a, b in zip(gone, b"\0" + gone[:-1])), sha256(bytes(c for c, g in zip(data, gone) if not g))))
    return out


def shingle_set(text, width):
    found = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} or ({tuple(found)} if found else set())


def near(rows, width, percent=80):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text), by comparing all pairs."""
    sets = {doc: shingle_set(text, width) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for doc in sorted(sets):
        shared = Counter(other for shingle in sets[doc] for other in having[shingle])
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[doc]) + len(sets[other]) - n):
                a, b = sorted((root(doc), root(other)))
                parent[b] = a
        for shingle in sets[doc]:
            having[shingle].append(doc)
    return [(doc, len(sets[doc]), root(doc), root(doc) == doc) for doc in sets]
