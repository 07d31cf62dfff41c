"""Plain, slow versions of the operators, from their contracts."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import xxhash
from newsloom.llm import quality_classifier as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


SPACELESS = "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"


def good(text, pipeline=False):
    """Whether no rule rejects a text; the pipeline takes few words of scripts without spaces."""
    text = text or ""
    n, chars, symbols, dup, repeated, failed = quality(text)
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    upper, letters = len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text))
    stutters = sum(a == b for a, b in zip(w, w[1:], strict=False))
    bars = sum(x.count("|") for x in lines if re.match(r"[\x20\x09-\x0D]*\|", x))
    odd = symbols - bars - len(re.findall(r"\$(?=[0-9])|(?<=[0-9])%", text))
    letters_alone = len(re.findall(SPACELESS, text))
    letters_alone = letters_alone if 2 * letters_alone > chars else 0
    if pipeline:
        failed = (n < 10 and letters_alone < 20) or 100 * repeated > 20 * n
    return not (
        failed or odd * 10 > chars or (letters >= 20 and upper * 10 > letters * 6) or stutters * 10 > n * 3
        or (len(lines) >= 4 and dup * 2 > len(lines)) or chars < 2 * n or (chars > 25 * n and not letters_alone)
    )


def simhash(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    """The root, by union-find, of each node; `linked` says of two nodes whether they are."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(digits[::-1]):
        n = int(d) * 2 if i % 2 else int(d)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    """(start, kind, end) of the base spans, in order."""
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


def disclosing(texts, window=8, min_texts=3, at=0.8, given=0.5):
    """Per text (start, end, share) of the terms that disclose a protected entity, wherever they stand."""
    texts = [t or "" for t in texts]
    near, words, holds, entities = [], [], Counter(), Counter()
    for text in texts:
        spans = personal(text)
        free = [m for m in re.finditer(r"[^\W_]{3,}", text) if not any(s < m.end() and m.start() < e for s, _, e in spans)]
        found = set()
        for s, k, e in spans:
            value = text[s:e].lower() if k < 2 else re.sub("[^0-9]", "", text[s:e])
            before = [m for m in free if m.start() < s][-window:]
            after = [m for m in free if m.start() >= s][:window]
            found |= {((k, value), m[0].lower()) for m in before + after}
        near.append(found)
        words.append(free)
        holds.update(set(re.findall(r"[^\W_]{3,}", text.lower())))
        entities.update({e for e, _ in found})
    both, seen = Counter(), defaultdict(set)
    for text, found in zip(texts, near, strict=True):
        both.update(found)
        for pair in found:
            seen[pair].add(text)
    n, share = len(texts), {}
    for (e, t), k in both.items():
        if len(seen[e, t]) >= min_texts and entities[e] < n and k / holds[t] >= given:
            bits = math.log2(k * n / (holds[t] * entities[e])) / math.log2(n / entities[e])
            if bits >= at:
                share[t] = max(share.get(t, 0), bits)
    return [[(m.start(), m.end(), share[m[0].lower()]) for m in free if m[0].lower() in share] for free in words]


def cleaned(text, terms, remove_at=0.95):
    kinds = ("EMAIL", "IP", "CARD", "PHONE")
    cuts = [(s, e, f"[{kinds[k]}]") for s, k, e in personal(text)]
    cuts += [(s, e, "" if x >= remove_at else "[TERM]") for s, e, x in terms]
    out, at = "", 0
    for s, e, tag in sorted(cuts):
        if s >= at:
            out += text[at:s] + tag
        at = max(at, e)
    return out + text[at:]


def mixed(rows, weights=(5, 2, 1), epochs=3):
    """{row number: (size, source_size, target, taken)} of (doc_id, source, text) rows."""
    sizes = [len(words(t)) for _, _, t in rows]
    total = defaultdict(int)
    for (_, source, _), n in zip(rows, sizes, strict=True):
        total[source] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, free = {}, sum(sizes), list(order)
    while free:
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > epochs * total[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = float(epochs * total[s])
            rest -= epochs * total[s]
            free.remove(s)
    out = {}
    for source in order:
        own = [i for i, r in enumerate(rows) if r[1] == source]
        own.sort(key=lambda i: hashlib.md5(("7" if rows[i][0] is None else f"{rows[i][0]}:7").encode()).hexdigest())
        budget = min(math.floor(target[source] + 0.5), epochs * total[source])
        for i in own:
            out[i] = [sizes[i], total[source], target[source], 0]
        while budget > 0 and total[source]:
            for i in own:
                n = min(budget, sizes[i])
                out[i][3] += n
                budget -= n
    return out


def packed(sizes, lengths, overhead):
    """Bins (length, items) of the packing rule, found by looking at all bins."""
    bins = []
    for i, size in enumerate(sizes):
        fits = [(room, k) for k, (room, _) in enumerate(bins) if room >= size]
        if fits:
            k = min(fits)[1]
        else:
            costs = []
            for length in sorted(lengths):
                if length >= size:
                    filled = size
                    for s in sizes[i + 1 :]:
                        filled += s if filled + s <= length else 0
                    costs.append(((length + overhead) / filled, length))
            bins.append([min(costs)[1], []])
            k = len(bins) - 1
        bins[k][0] -= size
        bins[k][1].append(i)
    return [(min(x for x in lengths if x >= sum(sizes[i] for i in items)), items) for _, items in bins]


def base32_sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def periodic_runs(words):
    """(start, length, period) of every maximal stretch with its smallest period, lag by lag."""
    n, found = len(words), []

    def smallest(stretch):
        """By the borders of all prefixes."""
        border = [0] * len(stretch)
        for i in range(1, len(stretch)):
            k = border[i - 1]
            while k and stretch[i] != stretch[k]:
                k = border[k - 1]
            border[i] = k + (stretch[i] == stretch[k])
        return len(stretch) - border[-1]

    for q in range(1, n // 3 + 1):
        start = 0
        for i in range(q, n + 1):
            if i < n and words[i] == words[i - q]:
                continue
            length = i - start
            if length >= max(24, 3 * q) and smallest(words[start:i]) == q:
                found.append((start, length, q))
            start = i - q + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def whitened(rows):
    """What whitening gives for (id, vector) rows, by NumPy's own eigenvectors."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array(x, float) - np.array([float(Fraction(s, n)) for s in sums])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    return {
        "n": n, "ids": [i for i, _ in rows], "explained": values / np.trace(v),
        "deviation": [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x],
        "whitened": centred @ vectors / np.sqrt(values),
    }


def chat_escape(text):
    return re.sub(r"([<\[])(\\*)(\||s>|/s>|INST\]|/INST\])", r"\1\\\2\3", text)


def chat_examples(rows):
    """(conv_id, example, n_turns, text, loss_start, loss_end) for rows of (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        said = [(r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        said.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        text, example = "", 0
        for k, (_, role, body) in enumerate(said, 1):
            text += "<|start|>" + chat_escape(role) + "<|message|>"
            start = len(text)
            text += chat_escape(body)
            end = len(text)
            text += "<|end|>"
            if role == "assistant":
                out.append((conv, example, k, text, start, end))
                example += 1
            elif k == len(said):
                out.append((conv, example, k, text, len(text), len(text)))
    return out


def chat_digests(rows):
    out = []
    for conv in {r[0] for r in rows}:
        said = [(r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        said.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        spoken = "".join(f"{role}\n{text}\n" for _, role, text in said)
        trained = "".join(text for _, role, text in said if role == "assistant")
        chars = sum(len(e[3]) for e in chat_examples([r for r in rows if r[0] == conv]))
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (spoken, trained)]
        out.append((conv, len(said), digests[0], len(trained), digests[1], chars))
    return out


def pooled_vectors(texts):
    """(hashes of frequent words, table, vectors of the texts) of the quality classifier, word by word."""
    places, signs = q.index_vectors()

    def index(row):
        vector = np.zeros(q.DIMS)
        vector[places[row]] = signs[row]
        return vector

    split = [(t or "").encode().split() for t in texts]
    counts = Counter(q.word_hash(q.cleaned(w)) for words in split for w in words)
    head = sorted(w for w, n in counts.items() if n * q.HEAD >= sum(counts.values()))

    place = {key: i for i, key in enumerate(head)}

    def row(word):
        key = q.word_hash(q.cleaned(word))
        return place.get(key, q.HEAD + key % q.SHARED)

    table = np.zeros((q.ROWS, q.DIMS))
    for words in split:
        for i, word in enumerate(words):
            for j in range(max(0, i - q.WINDOW), min(len(words), i + q.WINDOW + 1)):
                if i != j:
                    table[row(word)] += index(row(words[j]))
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    vectors = []
    for words in split:
        if not words:
            vectors.append(np.zeros(q.FEATURES))
            continue
        rows = [row(w) for w in words]
        own = table[rows]
        shapes = np.mean([index(q.shape(q.signs(w))) for w in words], axis=0)
        pairs = list(zip(rows, rows[1:]))
        n = max(len(pairs), 1)
        figures = [sum(table[a] @ table[b] for a, b in pairs) / n, sum(a == b for a, b in pairs) / n, np.log1p(len(words))]
        vectors.append(np.concatenate([own.mean(axis=0), own.std(axis=0), shapes, figures]))
    return head, table, vectors
