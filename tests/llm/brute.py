"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import defaultdict

LEAST = -(10**30)  # order of a null id


def order(doc_id):
    return LEAST if doc_id is None else doc_id


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def line_dedup(rows, min_chars=40, min_docs=5):
    """``rows``: (doc_id, text). Returns (doc_id, n_lines, n_dropped, kept_text) of each row."""
    key = lambda line: lower(line.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [
            len(holders.get(key(x), ())) >= min_docs and order(doc_id) != max(map(order, holders[key(x)])) for x in lines
        ]
        out.append((doc_id, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def shingle_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_duplicates(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) of each row."""
    sets = [shingle_set(text) for _, text in rows]
    name = list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                name[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = None if doc_id is None else min(least[root(i)])
        out.append((doc_id, len(sets[i]), component, doc_id is None or doc_id == component))
    return out


def contamination(rows, items, window=10):
    """(doc_id, n_words, n_hit, items) of each row."""
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add("" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        words, hit, found = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= own
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return out


def repeats(rows, match=50):
    """(doc_id, n_bytes, n_removed, spans, kept_sha256) of each row."""
    owner = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - match + 1):
            gram = data[k : k + match]
            owner[gram] = min(owner.get(gram, order(doc_id)), order(doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - match + 1):
            if owner[data[k : k + match]] < order(doc_id):
                gone[k : k + match] = b"\1" * match
        edges = [k for k in range(len(data) + 1) if (gone[k] if k < len(data) else 0) != (gone[k - 1] if k else 0)]
        spans = list(zip(edges[::2], edges[1::2]))
        out.append((doc_id, len(data), sum(gone), spans, sha(bytes(x for x, g in zip(data, gone) if not g))))
    return out
