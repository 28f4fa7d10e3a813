"""The queries' contracts as plain Python over whole small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), failed)


def url_rule(url):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOW)
    best = None
    for rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best or ""):
            best = rule
    return host, path, best, rules.get(best)


def warc(pages, least=0):
    """{page_id: row}; pages: (page_id, html)."""
    digest = {i: (len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())
              for i, h in pages}
    first = {}
    for i, key in sorted(digest.items()):
        first.setdefault(key, i)
    return {i: (*k, "response", None) if first[k] == i or k[0] < least else (*k, "revisit", first[k])
            for i, k in digest.items()}


def token_ids(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def lines(docs, min_chars=40, min_docs=5):
    """docs: (doc_id, text) with ids unique."""
    holders = defaultdict(set)
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate(LOW)
    for i, text in docs:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    out = {}
    for i, text in docs:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(h := holders.get(key(x), ())) < min_docs or max(h) == i]
        out[i] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))
    return out


def shingles(text, n=4):
    words = WORD.findall((text or "").translate(LOW))
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def components(docs, percent=85, n=4):
    """{doc_id: (n_shingles, component)}"""
    sets = {i: shingles(t, n) for i, t in docs}
    index = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in index[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    found = [(i, label) for p, label in phrases.items() for i in range(len(words))
             if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
