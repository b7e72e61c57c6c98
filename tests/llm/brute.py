"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter


def components(nodes, linked):
    """Least node of each node's component; ``linked(a, b)`` says who links."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(nodes), 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def jaccard_groups(docs, size, percent):
    """{id: (set size, component)} of (id, text) pairs with distinct ids."""
    s = {i: shingles(t, size) for i, t in docs}
    comp = components(s, lambda a, b: s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]))
    return {i: (len(s[i]), comp[i]) for i in s}


WORD5 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=10):
    """{id: (n_words, n_hit, item ids)}; ids of items are strings."""
    wins = {}
    for item, text in items:
        w = WORD5.findall(lower(text or ""))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(item)
    out = {}
    for i, text in docs:
        w = WORD5.findall(lower(text or ""))
        hit, who = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    who |= wins[tuple(w[k:k + n])]
        out[i] = (len(w), len(hit), sorted(who))
    return out


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), times=3):
    """{source: target} of {source: size}; None orders last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(times * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        if not open_:
            return {s: float(times * sizes[s]) for s in order}
        share = {s: w[s] * float(rest) / float(sum(w[x] for x in open_)) for s in open_}
        over = {s for s in open_ if w[s] * rest > times * sizes[s] * sum(w[x] for x in open_)}
        if not over:
            return {**{s: float(times * sizes[s]) for s in full}, **share}
        full |= over


def mix(docs, times=3, seed="mix"):
    """{id: taken words} of (id, source, size) with distinct ids."""
    sizes = {}
    for _, s, n in docs:
        sizes[s] = sizes.get(s, 0) + n
    t = targets(sizes)
    key = lambda i: hashlib.md5((seed + ("" if i is None else str(i))).encode()).hexdigest()
    copies = []
    for s in sizes:
        end = 0
        for twin, (i, _, n) in enumerate(sorted((d for d in docs if d[1] == s), key=lambda d: (key(d[0]), d[2]))):
            end += n
            for e in range(times):
                finish = float(e * sizes[s] + end) / t[s] if t[s] > 0 else 0.0
                copies.append((finish, s is not None, (s or "").encode(), key(i), e, twin, i, n))
    budget, upto, taken = sum(sizes.values()), 0, {i: 0 for i, *_ in docs}
    for *_, i, n in sorted(copies):
        upto += n
        if upto <= budget:
            taken[i] += n
    return taken, t


def simhash_words(line):
    return WORD5.findall(lower(line))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def line_components(lines, similarity):
    """Least member of the component of each of the lines (tuples of words)."""
    by_size = sorted(lines, key=len)
    root = {x: x for x in by_size}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = [Counter(x) for x in by_size]
    for i, a in enumerate(by_size):
        for j in range(i + 1, len(by_size)):
            b = by_size[j]
            most = int(len(b) * (1 - similarity) + 1e-9)
            if len(b) - len(a) > most:
                break  # longer ones differ by more: the gap grows faster than what is allowed
            lack = len(b) - sum(min(n, bags[j][w]) for w, n in bags[i].items() if w in bags[j])
            if lack <= most and edit_distance(a, b) <= most:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in by_size}


def dropped_lines(docs, similarity):
    """{id: dropped line numbers} of (id, text) with distinct ids."""
    at = [(i, k, tuple(simhash_words(x))) for i, t in docs for k, x in enumerate((t or "").split("\n"))]
    at = [x for x in at if x[2]]
    comp = line_components({w for _, _, w in at}, similarity)
    first = {}
    for i, k, w in at:
        first[comp[w]] = min(first.get(comp[w], (i, k)), (i, k))
    out = {}
    for i, k, w in at:
        if first[comp[w]] != (i, k):
            out.setdefault(i, set()).add(k)
    return {i: sorted(k) for i, k in out.items()}


def pagerank(edges, seeds, damping, rounds):
    """{host: rank} of {(src, dst): w} and {host: s}."""
    total = {}
    for (a, _), w in edges.items():
        total[a] = total.get(a, 0) + w
    start = {h: (1 - damping) * s for h, s in seeds.items() if s > 0}
    rank = dict(start)
    for _ in range(rounds):
        new = dict(start)
        for (a, b), w in edges.items():
            if a in rank:
                new[b] = new.get(b, 0) + damping * w / total[a] * rank[a]
        rank = new
    return rank


def ascii_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs(words, least=24, times=3):
    """(start, length, period) of every periodic run, by lag and place."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, times * q):
                x = words[start:start + length]
                if not any(x[d:] == x[:length - d] for d in range(1, q)):
                    out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def toxic_hits(text, terms, exceptions, fold):
    """(start, end, weight) by looking at every word of the folded text; ``fold`` keeps the length."""
    folded = " " + fold(text or "") + " "
    calm = set()
    for phrase in exceptions:
        key = " " + " ".join(fold(phrase).split()) + " "
        at = folded.find(key)
        while at >= 0:
            calm.add((at + 1, at + len(key) - 1))
            at = folded.find(key, at + 1)
    out = []
    for s in range(1, len(folded)):
        if folded[s - 1] != " ":
            continue
        fits = [(w, len(t)) for t, w in terms.items() if folded.startswith(fold(t), s) and (len(t) >= 4 or folded[s + len(t)] == " ")]
        fits = [(w, n) for w, n in fits if not any(a <= s and s + n <= b for a, b in calm)]
        if fits:
            w, n = max(fits, key=lambda f: f[0])
            out.append((s - 1, s - 1 + n, w))
    return out


def toxic_score(text, lexicon, fold):
    """The logistic curve of the hits' weights over the square root of the length."""
    import math
    hits = toxic_hits(text, lexicon.terms, lexicon.exceptions, fold)
    x = sum(w for _, _, w in hits) / math.sqrt(1 + len(text) / 100) if hits else 0.0
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, lexicon.offset + lexicon.slope * x))))


SECRET_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"


def random_spans(text, base, ratio, threshold, total, shortest=8, least=16):
    """Spans of kind random: runs less the base spans, then whole pieces or their best stretches.

    ``ratio(before, char)`` is the log-likelihood ratio of one transition (before is None at a border).
    """
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        a, b = m.span()
        if b - a < shortest:
            continue
        pieces, at = [], a
        for x, y, _ in sorted(s for s in base if s[0] < b and a < s[1]):
            pieces.append((at, x))
            at = max(at, y)
        for p, q in [*pieces, (at, b)]:
            if q - p < shortest:
                continue
            score = [ratio(text[k - 1] if k > p else None, text[k]) for k in range(p, q)]
            if q - p >= least and sum(score) >= threshold * (q - p):
                out.append((p, q))
                continue
            k = 0
            while k < len(score):
                upto = best = 0.0
                end = k
                j = k
                while j < len(score):
                    upto += score[j]
                    j += 1
                    if upto > best:
                        best, end = upto, j
                    if upto <= 0 or upto <= best - total:
                        break
                if best >= total:
                    x, y = p + k, p + end
                    while x > p and text[x - 1] not in "/=_-":
                        x -= 1
                    while y < q and text[y] not in "/=_-":
                        y += 1
                    parts = [(w.start() + x, w.end() + x) for w in re.finditer(r"[^/=_-]+", text[x:y])]
                    told = [(i, j2) for i, j2 in parts if sum(score[i - p:j2 - p]) > 0]
                    if told:
                        x, y = told[0][0], told[-1][1]
                    if out and x < out[-1][1]:
                        x = out.pop()[0]
                    if y - x >= shortest:
                        out.append((x, y))
                k = j
    return out


def quality_statistics(text):
    """The document statistics by their definitions."""
    import math
    raw = lower(text or "").encode()
    data, words_ = (text or "").encode(), raw.split()
    n, size = len(words_), len(data)
    per = lambda k: k / max(1, size)
    lens = [len(w) for w in words_]
    mean = sum(lens) / max(1, n)
    lines = [x for x in data.split(b"\n") if x]
    share = lambda xs: 1 - len(set(xs)) / len(xs) if xs else 0.0
    triples = list(zip(words_, words_[1:], words_[2:]))
    worded = [tuple(x.lower().split()) for x in lines if x.split()]
    signs, stops = b"#$%&*+/<=>@[\\]^_`{|}~!", b".,;:?'\"()-"
    return [math.log1p(size), math.log1p(n), mean, math.sqrt(max(0.0, sum(x * x for x in lens) / max(1, n) - mean * mean)),
            per(sum(65 <= b <= 90 for b in data)), per(sum(48 <= b <= 57 for b in data)), per(sum(b in signs for b in data)),
            per(sum(b in stops for b in data)), per(sum(b >= 128 for b in data)), len(lines) / max(1, n),
            sum(w[-1] in signs for w in words_) / n if n else 0.0, len(set(words_)) / n if n else 0.0,
            max(Counter(words_).values()) / n if n else 0.0, share(triples), share(worded) if len(worded) > 1 else 0.0,
            sum(x <= 3 for x in lens) / n if n else 0.0, per(data.count(b"!")), per(data.count(b"|")), math.log1p(n / max(1, len(lines)))]


def isotonic(points):
    """Isotonic regression of (x, y, weight) with distinct ascending x, by the min-max formula."""
    y, w = [p[1] for p in points], [p[2] for p in points]
    mean = lambda a, b: sum(y[k] * w[k] for k in range(a, b)) / sum(w[a:b])
    n = len(points)
    return [max(min(mean(a, b) for b in range(k + 1, n + 1)) for a in range(k + 1)) for k in range(n)]
