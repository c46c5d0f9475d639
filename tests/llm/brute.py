"""The operators' results by plain Python over all rows, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def substrings(docs, length=200):
    """Removed bytes of (doc_id, text) rows: id, bytes, removed, spans, digest."""
    texts = [(text or "").encode() for _, text in docs]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(docs, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    own = words(text)
    windows = defaultdict(list)
    for i in range(len(own) - 7):
        windows[tuple(own[i : i + 8])].append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(own)
    failed = n < 20 or 100 * len(hit) > 30 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(hit), failed


def contamination(docs, items):
    """n_words, n_hit, n_items, digest of the items' ids, for (id, text) rows."""
    cut = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item_id, text in items:
        own = re.findall(cut, lower(text))
        if own:
            size = min(10, len(own))
            for i in range(len(own) - size + 1):
                windows[tuple(own[i : i + size])].add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        own = re.findall(cut, lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if ids := windows.get(tuple(own[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= ids
        named = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(named), digest))
    return out


def near_groups(docs, size=3, percent=85):
    """n_shingles and component_id of (doc_id, text) rows, all pairs compared."""
    sets = []
    for _, text in docs:
        own = words(lower(text))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        sets.append(grams or ({tuple(own)} if own else set()))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j > i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(j)] = root(i)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        least[root(i)].append(doc_id)
    return [(d, len(sets[i]), min(least[root(i)])) for i, (d, _) in enumerate(docs)]


def targets(sizes):
    """Target of each source in words, by resharing round after round."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] if None in sizes else []
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full, left, target = set(), float(sum(sizes.values())), {}
    while len(full) < len(order):
        rest = [s for s in order if s not in full]
        share = left / sum(weight[s] for s in rest)
        over = [s for s in rest if share * weight[s] > 3 * sizes[s]]
        if not over:
            target |= {s: share * weight[s] for s in rest}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            full.add(s)
    return target


def letter_grams(text, buckets_log2=12):
    """Counts by bucket of the 2- and 3-byte grams of a text, letters folded to small ones."""
    folded, before = [], 0
    for byte in (text or "").encode():
        if byte >= 128:
            folded.append(byte + 32 if before == 0xC3 and 0x80 <= byte <= 0x9E else byte)
        else:
            folded.append(ord(chr(byte).lower()) if chr(byte).isalpha() else 32)
        before = byte
    found = Counter()
    for size in (2, 3):
        for i in range(len(folded) - size + 1):
            gram = folded[i : i + size]
            if gram != [32] * size:
                number = int.from_bytes(bytes(gram), "big")
                found[(number * 2654435761 + size) % 2**32 >> 32 - buckets_log2] += 1
    return found


def similarities(text, rarity, centroids):
    """Cosine of a text's weighted grams with each centroid; and how many grams it has."""
    grams = letter_grams(text)
    weights = {b: math.log1p(n) * float(rarity[b]) for b, n in grams.items()}
    length = math.sqrt(sum(w * w for w in weights.values())) or 1.0
    near = [sum(w * float(c[b]) for b, w in weights.items()) / length for c in centroids]
    return near, sum(grams.values())
